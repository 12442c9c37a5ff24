"""All registered queries."""

from salescope.plans import derivation, evaluation, features, inference, models, profiling, segments, tables  # noqa: F401
from salescope.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
