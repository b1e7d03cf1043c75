"""Operator 3: mix sources to target weights with hash-threshold histograms.

Every document gets a 60-bit hash of its id. A source whose target is ``r`` times its size
plus a remainder ``b`` takes every document ``r`` times, and once more those documents whose
hash lies below a threshold chosen so that their words sum to ``b``. The threshold is found
without sorting documents: words are summed by (source, leading 15 hash bits), a cumulative
sum over those buckets finds the one in which the budget ends, and only that bucket is split by
the next 15 bits, four times, until a single hash value is left. Documents at exactly that value
take their share of what remains of the budget, in words.

Edge cases: NULL text has size 0; NULL source is a source of its own, last in order; rows with
equal ids share a hash and are taken alike; sources without words get target 0; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_names, materialise, read_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
LEVELS, LEVEL_BITS = 4, 15
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(c: Column) -> Column:
    """60-bit hash of an id: the leading 15 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from rows (source, size): one row per source.

    Sources in code-point order take ``weights`` in turn. Weighted shares above
    ``max_repeats`` times a source's size are cut there and reshared. In order of cap/weight
    a prefix of the sources is cut, so the level follows from running sums over the source
    rows (one row per source, never per document).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    per = (per.withColumn("_i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
           .withColumn("_w", w.cast("long"))
           .withColumn("_cap", F.col("source_size") * max_repeats))
    order = [(F.col("_cap") / F.col("_w")).asc(), F.col("_i").asc()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("_caps", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
           .withColumn("_gone", F.coalesce(F.sum("_w").over(before), F.lit(0)))
           .withColumn("_all", F.sum("source_size").over(everything))
           .withColumn("_weights", F.sum("_w").over(everything)))
    # Words left per unit of weight if every earlier source is cut at its cap.
    level = (F.col("_all") - F.col("_caps")).cast("double") / (F.col("_weights") - F.col("_gone"))
    per = per.withColumn("_level", level).withColumn("_cut", F.col("_cap") < F.col("_level") * F.col("_w"))
    # The level that holds is that of the first source that isn't cut.
    final = F.min(F.when(~F.col("_cut"), F.struct(F.col("_cap") / F.col("_w"), F.col("_i"), F.col("_level")))
                  ).over(everything)["_level"]
    target = F.when(F.col("_cut"), F.col("_cap").cast("double")).otherwise(F.col("_w") * F.col("_final"))
    return per.withColumn("_final", final).select("source", "source_size", target.alias("target"))


def _thresholds(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, _cut_hash, _left, _at): the boundary hash value of each source, the words of the
    budget left for it, and the words of the documents that have it."""
    bound = targets.where(F.col("source_size") > 0).select(
        F.col("source").alias("_s"),
        (F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).alias("_left"),
        F.lit(0).cast("long").alias("_prefix")).where(F.col("_left") > 0)
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        bucket = F.shiftright(F.col("_h"), shift)
        inside = docs.join(bound, docs["source"].eqNullSafe(bound["_s"]) & (
            F.shiftright(F.col("_h"), shift + LEVEL_BITS) == F.col("_prefix")), "inner")
        hist = inside.groupBy("_s", bucket.alias("_b")).agg(F.sum("size").alias("_n"), F.first("_left").alias("_left"))
        running = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        # The last bucket that starts below the budget holds its end.
        bound = hist.where(F.col("_before") < F.col("_left")).groupBy("_s").agg(
            F.max(F.struct("_b", "_before", "_left", "_n")).alias("_x")).select(
            "_s", (F.col("_x._left") - F.col("_x._before")).alias("_left"), F.col("_x._b").alias("_prefix"),
            F.col("_x._n").alias("_at"))
        bound = bound if level == LEVELS - 1 else bound.drop("_at")
    return bound.select("_s", F.col("_prefix").alias("_cut_hash"), "_left", "_at")


def _planned(documents: DataFrame, weights: Sequence[int], max_repeats: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, _h) per document, and (_src, source_size, target, _cut_hash, _left, _at) per source."""
    docs = materialise(documents.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                        id_hash(F.col("doc_id")).alias("_h")), "mix_sizes")
    targets = materialise(source_targets(docs, weights, max_repeats), "mix_targets")
    cuts = materialise(_thresholds(docs, targets), "mix_cuts")
    plan = targets.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_src"), "source_size", "target", "_cut_hash", "_left", "_at")
    return docs, plan


def _taken(size: Column, h: Column, source_size: Column, target: Column, cut_hash: Column, left: Column, at: Column) -> Column:
    """Words that the mix takes of a document, by its size and hash and its source's plan."""
    repeats = F.coalesce(F.floor(target / F.nullif(source_size, F.lit(0))), F.lit(0))
    share = F.floor(F.least(left / at, F.lit(1.0)) * size)
    extra = F.when(cut_hash.isNull() | (h > cut_hash), F.lit(0)).when(h < cut_hash, size).otherwise(share)
    return (repeats * size + extra).cast("long")


_PLAN = ("source_size", "target", "_cut_hash", "_left", "_at")


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per document.

    ``taken`` is how many words of the document the mix holds, repeats counted; it is a whole multiple of
    ``size`` except at the boundary hash of its source.
    """
    docs, plan = _planned(documents, weights, max_repeats)
    out = docs.join(plan, F.col("source").eqNullSafe(F.col("_src")), "inner")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      _taken(F.col("size"), F.col("_h"), *map(F.col, _PLAN)).alias("taken"))


def op3_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("source")


def keep_mixed(documents: DataFrame) -> DataFrame:
    """Documents as the mix holds them: each repeated as often as its taken words fill it, rounded.

    A document's copies follow from its own id and text and its source's plan, so texts meet one row per source (sent to
    the tasks while it is small) and are not shuffled. Documents without words are left out.
    """
    names = fresh_names(documents, "_src", *_PLAN, "_size", "_copy")
    size, copy = F.col(names[-2]), names[-1]
    plan = materialise(_planned(documents, WEIGHTS, MAX_REPEATS)[1], "mix_plan").toDF(*names[:-2])
    joined = documents.withColumn(names[-2], word_count(F.col("text"))).join(
        plan, F.col("source").eqNullSafe(F.col(names[0])), "inner")
    taken = _taken(size, id_hash(F.col("doc_id")), *map(F.col, names[1:-2]))
    copies = F.when(size > 0, F.floor((2 * taken + size) / (2 * size))).otherwise(0).cast("int")
    return joined.select(*documents.columns, F.explode(F.array_repeat(F.lit(True), copies)).alias(copy)).drop(copy)


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, source_size, i, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
        FROM d GROUP BY source)),
t AS (
  SELECT *, CAST(total - caps AS DOUBLE) / (weights - gone) AS lvl
  FROM (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(w) OVER () AS BIGINT) AS weights,
               CAST(coalesce(sum(cap) OVER o, 0) AS BIGINT) AS caps, CAST(coalesce(sum(w) OVER o, 0) AS BIGINT) AS gone,
               row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / w, i) AS k
        FROM s WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
f AS (SELECT arg_min(lvl, k) AS final FROM t WHERE NOT cap < lvl * w),
g AS (
  SELECT source, source_size, CASE WHEN cap < lvl * w THEN CAST(cap AS DOUBLE) ELSE w * final END AS target FROM t, f),
r AS (
  SELECT d.*, g.source_size, g.target,
         CASE WHEN g.source_size = 0 THEN 0 ELSE floor(g.target / g.source_size) END AS reps
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
b AS (
  SELECT *, target - reps * source_size AS budget,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
           AS upto,
         sum(size) OVER (PARTITION BY source, h) AS tied
  FROM r)
SELECT doc_id, size, source_size, target,
       CAST(reps * size + CASE WHEN budget <= 0 OR upto - tied >= budget THEN 0
                               WHEN upto <= budget THEN size
                               ELSE floor(least((budget - (upto - tied)) / tied, 1.0) * size) END AS BIGINT) AS taken
FROM b
"""
