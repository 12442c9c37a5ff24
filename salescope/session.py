"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}
_WRITTEN: list[str] = []


def get_spark(app: str = "salescope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.dataFrameQueryContext.enabled": "false",
        "spark.ui.enabled": "false",
    }
    for k, v in {**defaults, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder stands in for it only when the session itself is
    local; a cluster session without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app_id = spark.sparkContext.applicationId
    if app_id not in _LOCAL_DIRS:
        _LOCAL_DIRS[app_id] = tempfile.TemporaryDirectory(prefix="salescope-", ignore_cleanup_errors=True)
    return _LOCAL_DIRS[app_id].name


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, so that reruns never overwrite."""
    return f"{checkpoint_dir(spark).rstrip('/')}/salescope/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later passes a columnar
    table with a known size: a join against it is broadcast by Catalyst only when
    the files are under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, tasks: Sequence[Callable], most: int = 4) -> list:
    """The results of independent tasks in order, up to ``most`` of them running in threads.

    A task submits Spark jobs. Fits are long rows of small jobs, so several at once use cores
    that one leaves idle between and at the end of its jobs.
    """
    with ThreadPool(max(1, min(most, len(tasks)))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(spark)(t) for t in tasks], chunksize=1)


def drop_materialized(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process, once no plan reads them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
