"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import cut


def _directed(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct ``u > v`` pairs."""
    return (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum, to see when a step changes nothing."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge except the roots; a root is its component's smallest node.

    Each step joins nodes to the smallest neighbour; the number of steps grows with
    the logarithm of the component size.  The table is written after each step,
    and only its count and checksum reach the driver.
    """
    now = cut(_directed(edges, "u", "v"), "components")
    before = None
    state = _state(now)
    while state != before and state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(joined.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = cut(_directed(small, "a", "b"), "components")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
