"""Connected components by alternating large and small stars, all on executors.

Each round is two joins on a node with the least of its neighbours, which is aggregated map-side first; nothing of a
neighbourhood is collected, and a node with very many neighbours is a skewed join key that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).collect()[0]
    return r[0], r[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the least node reachable, the node itself included.

    Edges with a null end are left out; loops and repeats do not matter; no edges give no rows.
    """
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"{a} is not null and {b} is not null") if {a, b} == {"a", "b"} else edges.select(F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b"))
    nodes = e = cut(e.where("a is not null and b is not null").distinct())
    e, seen = e.where("a <> b"), None
    while True:
        e = cut(_small_star(_large_star(e)))
        now = _state(e)
        if now == seen:
            break
        seen = now
    roots = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return roots.join(e.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
