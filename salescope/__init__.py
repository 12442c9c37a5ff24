"""salescope: catalogue and sales analytics written as Spark jobs."""
