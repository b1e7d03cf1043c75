"""Data-quality checks (K1-K15) run on every refresh.

Each check returns the *violating* rows as a DataFrame (empty = pass), except
the domain profile (K4), which returns the distinct values to inspect. The
suite runner turns a list of checks into one ``(check, table, violations)``
frame computed in a single job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: Sequence[str], include_null: bool = False) -> DataFrame:
    """Keys that occur more than once (K1); with ``include_null`` also NULL keys (K2)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    cond = F.col("n") > 1
    if include_null:
        for k in keys:
            cond = cond | F.col(k).isNull()
    return g.where(cond)


def bad_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate or NULL primary keys (K2)."""
    return duplicates(df, keys, include_null=True)


def long_form(df: DataFrame, cols: Sequence[str], as_string: bool = False) -> DataFrame:
    """``(column, value)`` for every row and listed column: one scan (``Expand``), not one per column."""
    src = df.select(*[F.col(c).cast("string").alias(c) if as_string else F.col(c) for c in cols])
    return src.unpivot([], list(cols), "column", "value")


def untrimmed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value)`` for every value with leading/trailing spaces (K3)."""
    return long_form(df, cols).where(F.col("value") != F.trim(F.col("value")))


def domain(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values per column, ``(column, value)`` (K4), one scan and one shuffle."""
    return long_form(df, cols, as_string=True).distinct()


def null_or_negative(df: DataFrame, c: str) -> DataFrame:
    """Rows whose measure is NULL or negative (K5)."""
    return df.where(F.col(c).isNull() | (F.col(c) < 0))


def date_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where ``later < earlier`` (K6); chain two calls for K7."""
    return df.where(F.col(later) < F.col(earlier))


def date_chain(df: DataFrame, first: str, second: str, third: str) -> DataFrame:
    """Rows breaking ``first <= second <= third`` (K7)."""
    return df.where((F.col(first) > F.col(second)) | (F.col(second) > F.col(third)))


def orphans_not_in(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``child WHERE key NOT IN (SELECT parent_key FROM parent)`` with SQL NULL semantics (K8).

    * empty parent: every child row (``x NOT IN ()`` is true, even for NULL x);
    * a NULL among parent keys: no row (the predicate is never true);
    * otherwise: non-NULL child keys absent from the parent.

    Planned as a regular left-anti join (sort-merge or broadcast, chosen from
    runtime size) plus two one-row ``EXISTS`` subqueries, instead of the
    null-aware anti join, whose fallback for a large parent is a nested loop.
    """
    pk = parent.select(F.col(parent_key).alias("_pk"))
    parent_empty = ~pk.exists()
    parent_has_null = pk.where(F.col("_pk").isNull()).exists()
    anti = child.join(pk.where(F.col("_pk").isNotNull()), F.col(key) == F.col("_pk"), "left_anti")
    return anti.where(parent_empty | (F.col(key).isNotNull() & ~parent_has_null))


def orphans(fact: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Fact rows without a matching dimension row, NULL keys included (K9)."""
    d = dim.select(F.col(dim_key or key).alias("_dk"))
    return fact.join(d, F.col(key) == F.col("_dk"), "left_anti")


def bad_int_date(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """``(column, value)`` of encoded dates that are zero, negative or not 8 digits."""
    v = F.col("value")
    return long_form(df, [cols] if isinstance(cols, str) else cols) \
        .where((v <= 0) | (F.length(v.cast("string")) != 8))


def sales_rule(df: DataFrame, sales: str = "sls_sales", qty: str = "sls_quantity",
               price: str = "sls_price") -> DataFrame:
    """Distinct ``(sales, quantity, price)`` breaking sales = quantity * price, all > 0, non-NULL."""
    s, q, p = F.col(sales), F.col(qty), F.col(price)
    holds = (s > 0) & (q > 0) & (p > 0) & (s == q * p)
    return df.where(~F.coalesce(holds, F.lit(False))).select(sales, qty, price).distinct()


def future_dates(df: DataFrame, c: str, as_of: Column) -> DataFrame:
    """Rows dated after ``as_of``."""
    return df.where(F.col(c) > as_of)


def conflicts(df: DataFrame, master: str, other: str, resolved: Column) -> DataFrame:
    """Distinct combinations of two sources' values and the resolved value."""
    return df.select(F.col(master), F.col(other), resolved.alias("resolved")).distinct()


def too_long(df: DataFrame, cols: Sequence[str], width: int = 50) -> DataFrame:
    """``(column, value)`` for text longer than the declared width."""
    return long_form(df, cols).where(F.length(F.col("value")) > width)


def count_where(*conds: Column) -> Column:
    """Aggregate: rows where each condition is TRUE, summed over the conditions
    (one condition per column for the per-column checks)."""
    out = None
    for c in conds:
        term = F.count_if(c)
        out = term if out is None else out + term
    return out


@dataclass(frozen=True)
class Check:
    """One check of the suite.

    ``violations`` is the violating-rows frame. Filter-only checks may instead
    give ``counts``: ``(source label, source frame, count aggregate, known count or None)``
    contributions. Those on one source whose count isn't known are computed in a
    single aggregation pass over it.
    """
    name: str
    table: str
    violations: DataFrame | None = None
    counts: tuple[tuple[str, DataFrame, Column, int | None], ...] = ()


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """``(check, table, violations)``: one row per check.

    Checks with ``counts`` are fused: one ``agg`` per source table computes
    every filter-only check on it, so a large table is scanned once for all of
    them rather than once per check. The others count their violation frames.
    """
    tables = {c.name: c.table for c in checks}
    parts = [c.violations.agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(c.name).alias("check"), F.lit(c.table).alias("table"), "violations")
             for c in checks if not c.counts]
    by_source: dict[str, tuple[DataFrame, list[tuple[str, Column]]]] = {}
    known: list[Column] = []
    for c in checks:
        for label, frame, expr, count in c.counts:
            if count is None:
                by_source.setdefault(label, (frame, []))[1].append((c.name, expr))
            else:
                known.append(F.struct(F.lit(c.name).alias("check"), F.lit(count).cast("bigint").alias("violations")))
    fused = []
    if known:
        spark = next(frame for c in checks for _, frame, _, _ in c.counts).sparkSession
        fused.append(spark.range(1).select(F.inline(F.array(*known))))
    for frame, items in by_source.values():
        slots = {f"_c{i}": name for i, (name, _) in enumerate(items)}
        row = frame.agg(*[expr.alias(slot) for slot, (_, expr) in zip(slots, items)])
        long = row.unpivot([], list(slots), "_slot", "violations")
        slot_to_check = F.create_map(*[F.lit(x) for kv in slots.items() for x in kv])
        fused.append(long.select(slot_to_check[F.col("_slot")].alias("check"), "violations"))
    if fused:
        table_of = F.create_map(*[F.lit(x) for kv in tables.items() for x in kv])
        summed = reduce(DataFrame.unionAll, fused).groupBy("check").agg(
            F.sum("violations").cast("bigint").alias("violations"))
        parts.append(summed.select("check", table_of[F.col("check")].alias("table"), "violations"))
    return reduce(DataFrame.unionAll, parts)


def first_duplicated_key(df: DataFrame, key: str):
    """The smallest key value that several rows hold (None without one)."""
    return duplicates(df.where(F.col(key).isNotNull()), [key]).agg(F.min(key).alias("k")).first()["k"]


def versions_of_key(df: DataFrame, key: str, value, newest: str) -> DataFrame:
    """P10: the rows of one key, numbered from the newest as ``latest_update``.

    The key is compared with a literal, so the scan skips row groups by their statistics, dictionaries and bloom filters.
    """
    order = Window.partitionBy(key).orderBy(F.col(newest).desc_nulls_first())
    return df.where(F.col(key) == F.lit(value)).withColumn("latest_update", F.row_number().over(order))
