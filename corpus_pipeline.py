"""Training-data pipeline over ``documents``: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared folder and
reread as the next stage's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm.common import materialise, read_table
from tierwise.llm.mixing import keep_mixed
from tierwise.llm.neardup import keep_representatives
from tierwise.llm.packing import pack
from tierwise.llm.quality import keep_good
from tierwise.llm.secrets import mask_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's bounds; the others go."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8), that with the smallest id."""
    return keep_representatives(docs, width=5, threshold=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return mask_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources holds them: left out, once or repeated."""
    return keep_mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("near duplicates", near_duplicates), ("secret scan", secrets),
          ("source mixture", mixture), ("sequence packing", packing)]

#: No SQL: the quality model, MinHash, compression and the tokeniser have none. tests/llm hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return docs
