"""Connected components of a link table, as repeated joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (both.join(low, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    joined = down.join(low, "a")
    return (joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
            .filter("a <> b").distinct())


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the
    smallest node of the component.

    Alternating large-star and small-star: each round keeps the edge count,
    takes one minimum per node (pre-aggregated, so a hub costs one row per
    task) and joins it back by a join that adaptive execution can split. The
    number of rounds grows with the logarithm of the longest path. Each round
    is stored, so lost executors do not undo it, in at most ``files`` files. Loops
    and NULL ends are ignored.
    """
    now = store(edges.select("a", "b").filter("a <> b").distinct(), files)
    count, digest = None, None
    while True:
        then = store(_small_star(_large_star(now)), files)
        state = then.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = then
        if (count, digest) == tuple(state):
            break
        count, digest = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
