"""Connected components as Spark joins: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.scratch import release, written


def _state(edges: DataFrame) -> tuple:
    """A digest of an edge table: one row, whatever its size."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b: bigint, no nulls); the component is its
    least node. Links are never gathered: each step is a minimum per node and a join back to
    the node's links, and its table is written to the shared folder. No edges give no rows."""
    links = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "links")
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        links = written(small, "links")
        now = _state(links)
        if now == state:
            break
        state = now
    release(edges.sparkSession)
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
