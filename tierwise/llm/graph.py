"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SALTS = 16


def _salted(edges: DataFrame, per_node: DataFrame) -> DataFrame:
    """Join edges (u, v) with (u, m), a hub's edges split over :data:`SALTS` keys."""
    left = edges.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    right = per_node.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, ["u", "_salt"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Each round is written to the shared folder; the number of rounds grows with the logarithm of the longest path,
    not with the size of the graph.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    e = materialise(e, "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = _salted(both, low).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _salted(large, low).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
