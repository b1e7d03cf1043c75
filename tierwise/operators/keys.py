"""Dense surrogate keys 1..n in key order without a single-partition sort (G1).

``ROW_NUMBER() OVER (ORDER BY k)`` sends every row to one task. Here the rows are dealt over ranges of the whole key order,
with bounds from Spark's sample of the keys, sorted within their range and written once with their place in it. A row's number
is its place plus the rows of all earlier ranges: a running sum over one row per range. What the keys look like (sparse
ids, one date on every row, a common prefix) doesn't matter, and the same plan serves every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Spark's row ids hold the partition above this bit and the place in the partition below it.
_PLACE_BITS = 33


def sorted_ranges(df: DataFrame, order: Sequence[Column], part: str, place: str) -> DataFrame:
    """``df`` with the number of each row's range of ``order`` and its place in the range, both from 0.

    Ranges ascend along ``order`` (NULL placement as given); together, (range, place) is the order. Rows alike in all of ``order``
    may lie in different ranges, so that a key on a third of the rows is dealt over several tasks; among
    themselves their order is arbitrary. The result is written to the shared folder and read back: one exchange, and no later
    reader can see another numbering.
    """
    spark = df.sparkSession
    tie, row = "_tie", "_row"
    while {tie, row} & set(df.columns):
        tie, row = "_" + tie, "_" + row
    keys = [*order, F.col(tie)]
    placed = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn(row, F.monotonically_increasing_id()).drop(tie)
    path = scratch_path(spark, "ranges")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    return rows.select(*df.columns, F.shiftright(row, _PLACE_BITS).cast("int").alias(part),
                       F.col(row).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(place))


def with_surrogate_key(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add a dense ``bigint`` key 1..n following ``order``, which should be total for a reproducible numbering."""
    part, place, first = "_part", "_place", "_first"
    while {part, place, first} & set(df.columns):
        part, place, first = "_" + part, "_" + place, "_" + first
    rows = sorted_ranges(df, order, part, place)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy(part).agg(F.count(F.lit(1)).alias(first)) \
        .select(part, F.coalesce(F.sum(first).over(before), F.lit(0)).alias(first))
    # One row per range, and no more ranges than shuffle partitions: bounded by a setting, not by the data.
    return rows.join(F.broadcast(firsts), part).select(
        (F.col(first) + F.col(place) + 1).cast("bigint").alias(name), *[F.col(c) for c in df.columns])
