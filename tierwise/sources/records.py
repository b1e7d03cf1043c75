"""Records of CSV files that may hold quoted line breaks, read in as many tasks as the files have blocks.

A record ends at a line break outside quotes, that is where the file has an even number of quotes up to there (as COPY
finds it: any quote counts, a doubled one counts twice). Each block of a file is read line by line; the parity of quotes and
the number of records are summed within the block, for either state in which it may begin, and a prefix sum over one row per block
tells which of both it is, and how many records lie before it. Only lines of records that span several are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_FILE = ["f", "g"]
_BLOCK = [*_FILE, "b"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(f, g: hashes of the file's path; b: first byte of its block; i: ascending in the block; odd: parity of quotes; value)."""
    name = F.col("_metadata.file_path")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(name).alias("f"), F.xxhash64(F.lit("path"), name).alias("g"),
        F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"),
        (quotes % 2).cast("int").alias("odd"), "value")


def _within_blocks(lines: DataFrame) -> DataFrame:
    """Adds, as if each block began outside quotes: ``quoted`` after the line, lines ``outside`` so far, and lines ``nth`` so far."""
    w = Window.partitionBy(*_BLOCK).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("quoted", (F.sum("odd").over(w) % 2).cast("int")) \
        .withColumns({"outside": F.sum(1 - F.col("quoted")).over(w), "nth": F.row_number().over(w)})


def _blocks(seen: DataFrame) -> DataFrame:
    """(block, open: 1 if it begins inside quotes, before: records that end in earlier blocks of the file)."""
    earlier = Window.partitionBy(*_FILE).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per_block = seen.groupBy(*_BLOCK).agg((F.sum("odd") % 2).alias("parity"), F.max("outside").alias("outside"),
                                          F.count(F.lit(1)).alias("m"))
    opened = per_block.withColumn("open", (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).cast("int"))
    ends = F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("m") - F.col("outside"))
    return opened.withColumn("ends", ends).select(
        *_BLOCK, "open", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("before"))


def _without_return(value: Column) -> Column:
    return F.when(value.endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(value)


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(value), one row per record of the file or folder of files at ``path``: its text with the line breaks inside quotes kept,
    without the one that ends it. Each file's first record is left out if it is a ``header``; blank lines are no records."""
    seen = _within_blocks(_lines(spark, path))
    # An outer join in form only: the lines are streamed, in order, past the few rows of blocks.
    placed = seen.join(_blocks(seen), _BLOCK, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("open", "before")})
    inside = (F.col("quoted") + F.col("open")) % 2
    ended = F.when(F.col("open") == 0, F.col("outside") - (1 - F.col("quoted"))) \
        .otherwise(F.col("nth") - F.col("outside") - F.col("quoted"))
    placed = placed.select(*_BLOCK, "i", "value", (F.col("before") + ended).alias("record"),
                           ((inside == 0) & (F.col("odd") == 0)).alias("whole"))
    if header:
        placed = placed.where("record > 0")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("b", "i", "value"))), lambda x: x["value"])
    spanning = placed.where(~F.col("whole")).groupBy(*_FILE, "record").agg(F.array_join(lines, "\n").alias("value"))
    records = spanning.select("value").unionByName(placed.where("whole").select("value"))
    return records.select(_without_return(F.col("value")).alias("value")).where("value <> ''")
