"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("b", "a"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them (edges have a < b)."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    own = least.select(F.col("m").alias("a"), "b")
    others = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
    return own.unionByName(others).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component_id`` (the smallest node reachable) for every node with an edge.

    ``edges``: two columns of numbers, any direction; loops and repeats do no harm.  Each round is
    written to the shared folder, so lost executors cost one round, and the plan stays short.
    """
    a, b = edges.columns
    clean = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    now = written(clean, "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component_id")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("component_id")).unionByName(roots)
