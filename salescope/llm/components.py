"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.session import materialize

MAX_ROUNDS = 100


def _smallest(edges: DataFrame, node: str, other: str) -> DataFrame:
    """The smallest neighbour of each node, as a table of its own.

    Written out, so that the join that follows meets two plain exchanges and adaptive
    execution can split the edges of a node that has very many.
    """
    return materialize(edges.groupBy(node).agg(F.min(other).alias("m")), "smallest")


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges (u, v), u > v, are stars: each u has one v, which is no u itself."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("top")).union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("top").alias("top"))
    return ends.agg(F.count(F.when(F.col("up") + F.col("top") > 1, 1))).first()[0] == 0


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for each node with an edge; the component is its smallest node.

    Alternates two steps until only stars are left: every node links its larger neighbours
    to its smallest one, then every node links its smaller neighbours and itself to its
    smallest one. Each is a minimum with a map-side combine and a join whose edge side
    may be split, so a hub is as cheap as its edges. Needs about log2 of the longest
    path in rounds. Edges with a null end or equal ends are left out.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"), F.col(src).alias("_s"), F.col(dst).alias("_d"))
    e = materialize(e.filter("_s is not null and _d is not null and u > v").select("u", "v").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _settled(e):
            break
        both = e.union(e.select("v", "u"))
        m = _smallest(both, "u", "v").select(F.col("u").alias("a"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").withColumnRenamed("u", "a").join(m, "a").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u > v"), "edges")  # no more rows than e has; repeated ones go below
        m = _smallest(large, "u", "v").withColumnRenamed("u", "a")
        small = large.withColumnRenamed("u", "a").join(m, "a").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(m.select("a", "m")).filter("u > v").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
