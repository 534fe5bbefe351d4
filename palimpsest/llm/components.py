"""Connected components of a link table, by alternating large and small stars in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame, keep_larger: bool) -> DataFrame:
    """For each u with neighbours v: links from these to the least of them and u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_least")).select(F.col("u").alias("_u"), F.least("_least", "u").alias("_least"))
    joined = pairs.join(least, F.col("u") == F.col("_u"))
    links = joined.where("v > u") if keep_larger else joined
    out = links.select(F.col("v").alias("a"), F.col("_least").alias("b"))
    if not keep_larger:
        out = out.unionByName(least.select(F.col("_u").alias("a"), F.col("_least").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of each id that has a link: component is the least id reachable.

    Links may repeat, run either way, or join an id with itself; nulls are left out. No links give no rows. Each round is
    written to the shared checkpoint folder; the number of rounds follows the logarithm of the longest path. What comes
    to the driver in a round is a count and a checksum.
    """
    start = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = cut(start.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, True)
        edges = cut(_star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), False))
        now = _state(edges)
        if now == state:
            break
        state = now
    tops = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops)
