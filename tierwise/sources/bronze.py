"""Bronze ingestion and layer management.

A layer is a namespace of parquet tables. Loads are full refreshes
(truncate-and-insert == ``mode("overwrite")``), so re-running a load is
idempotent and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import csv_records
from .schemas import AUDIT_COL, BRONZE, BRONZE_FILES, LOOKUP_KEYS, stored

LAYERS = ("bronze", "silver", "gold")

def read_bronze(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV extract -> typed bronze DataFrame.

    Header skipped, columns taken by position against the declared schema,
    and any malformed row fails the load (``COPY`` semantics). As in
    ``COPY ... FORMAT csv``, an unquoted empty field is NULL while a quoted
    empty field (``""``) is an empty string, a doubled quote inside quotes is one
    quote, a backslash is an ordinary character, and a quoted field may hold line
    breaks. Files are split over tasks all the same (:mod:`.records`).
    """
    schema = BRONZE[table]
    # What the parser puts in for an unquoted empty field: random, so that no field's text can be it.
    missing = uuid.uuid4().hex
    row = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), {
        "mode": "FAILFAST", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "quote": '"', "escape": '"', "multiLine": "true", "nullValue": missing, "emptyValue": "",
        "dateFormat": "yyyy-MM-dd", "timestampNTZFormat": "yyyy-MM-dd[ HH:mm:ss]"})
    return csv_records(spark, path).select(row.alias("row")).select("row.*")


def write_extract(df: DataFrame, path: str) -> None:
    """Write a table as a CSV extract in the layout :func:`read_bronze` expects: header row,
    ``""`` for an empty string, nothing for NULL, dates and timestamps as text, and
    leading/trailing spaces kept (Spark's CSV writer trims them by default)."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"')
     .option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(path))


def read_all_bronze(spark: SparkSession, landing: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    files = files or BRONZE_FILES
    return {t: read_bronze(spark, os.path.join(landing, f), t) for t, f in files.items()}


def ensure_layers(spark: SparkSession, layers=LAYERS, root: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` for each layer (S4), optionally located under ``root``."""
    for layer in layers:
        loc = f" LOCATION '{os.path.join(root, 'catalog', layer)}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{loc}")


def publish_table(spark: SparkSession, root: str, layer: str, table: str) -> str:
    """Expose a materialised table as the catalog view ``layer.table``."""
    path = os.path.join(root, layer, table)
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS SELECT * FROM parquet.`{path}`")
    return f"{layer}.{table}"


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` in the columns and types of a declared schema, by store assignment: widening casts only, anything else fails
    when the plan is made, an overflow when it runs (S5). The columns must be those declared, in any order."""
    if sorted(df.columns) != sorted(contract.names):
        raise ValueError(f"columns {sorted(set(df.columns) ^ set(contract.names))} don't match the declared schema")
    return df.to(stored(contract))


def too_wide(widths: dict[str, int]) -> Column:
    """Whether some text of a row is wider than declared; a NULL isn't."""
    return F.greatest(F.lit(False), F.lit(False), *[F.coalesce(F.length(c) > w, F.lit(False)) for c, w in widths.items()])


def within_widths(df: DataFrame, widths: dict[str, int], mode: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows to load, rows rejected or None) under ``mode`` keep, fail or reject."""
    if mode not in ("keep", "fail", "reject"):
        raise ValueError(f"mode must be keep, fail or reject, not {mode}")
    if mode == "keep" or not widths:
        return df, None
    if mode == "reject":
        which = [F.when(F.length(c) > w, F.lit(c)) for c, w in widths.items()]
        return df.where(~too_wide(widths)), df.where(too_wide(widths)).withColumn("too_wide", F.concat_ws(",", *which))
    return df.withColumns({c: F.when(F.length(c) > w, F.raise_error(F.lit(f"value too long for {c} varchar({w})")))
                           .otherwise(F.col(c)) for c, w in widths.items()}), None


def with_audit(df: DataFrame) -> DataFrame:
    """Append the load timestamp column."""
    return df.withColumn(AUDIT_COL, F.localtimestamp())


def lookup_options(columns: Iterable[str]) -> dict[str, str]:
    """Parquet writer options that give ``columns`` a bloom filter per row group, sized by the values that it meets.

    A lookup by such a key skips the row groups that don't hold it, however the rows are ordered.
    """
    keys = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**keys, "parquet.bloom.filter.adaptive.enabled": "true"} if keys else {}


def write_layer(df: DataFrame, root: str, layer: str, table: str) -> str:
    """Truncate-and-load one table as parquet under ``root/layer/table`` (S2/S3), its lookup keys with bloom filters (P10)."""
    path = os.path.join(root, layer, table)
    df.write.options(**lookup_options(c for c in LOOKUP_KEYS.get(table, ()) if c in df.columns)).mode("overwrite").parquet(path)
    return path


def read_layer(spark: SparkSession, root: str, layer: str, table: str, schema=None) -> DataFrame:
    """Read a materialised table; with the writer's ``schema`` no inference job is needed."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(os.path.join(root, layer, table))

