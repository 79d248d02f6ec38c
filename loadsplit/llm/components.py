"""Connected components of an edge table by alternating large-star and
small-star steps, each a partial aggregate and a join, staged as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges with a > b, loops dropped."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Node and its smaller neighbours go to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    up = low.select("a", F.col("m").alias("b"))
    return edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .unionByName(up).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node that
    can be reached. Ends when a round leaves the edges as they were, after a
    number of rounds that grows with the logarithm of the longest path."""
    now = stage(_ordered(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))).distinct(), "components")
    state = _state(now)
    while state[0]:
        now = stage(_small_star(stage(_large_star(now), "components")), "components")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
