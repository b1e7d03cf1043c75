"""Reusable bronze -> silver cleansing operators.

Each is a pure ``DataFrame -> DataFrame`` (or Column) function. None of them
shuffles except :func:`latest_per_key` (one exchange on the key) and
:func:`add_valid_to` (one exchange on the entity key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import (
    col, int_div, int_to_date, map_codes, remove_chars, strip_prefix,
)

# Fixed values of the source system's code sets.
MARITAL_CODES = {"S": "Single", "M": "Married"}
GENDER_CODES = {"F": "Female", "M": "Male"}
PRODUCT_LINE_CODES = {"R": "Road", "M": "Mountain", "S": "other Sales", "T": "Touring"}
UNKNOWN = "Unknown"
# Country default keeps the source spelling 'Unkown' (load script as shipped).
COUNTRY_UNKNOWN = "Unkown"
COUNTRY_CODES = {"DE": "Germany", "US": "United States", "USA": "United States"}


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tiebreak: Sequence[Column] = (), drop_null_keys: bool = True) -> DataFrame:
    """Keep one row per key: the first by ``order`` then ``tiebreak``.

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``. Catalyst turns
    the rank filter into a partial ``WindowGroupLimit`` before the shuffle,
    so each map task forwards at most one row per key: a key holding a third
    of all rows does not land in one reducer task.
    """
    if drop_null_keys:
        for k in keys:
            df = df.where(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strip leading/trailing spaces from text columns."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def standardise_gender(c) -> Column:
    return map_codes(c, GENDER_CODES, UNKNOWN)


def standardise_marital(c) -> Column:
    return map_codes(c, MARITAL_CODES, UNKNOWN)


def standardise_line(c) -> Column:
    return map_codes(c, PRODUCT_LINE_CODES, UNKNOWN)


def standardise_erp_gender(c, fix_gender_case: bool = False) -> Column:
    """ERP gender (E4). As shipped, spelled-out values are compared to
    ``UPPER(TRIM(gen))`` in mixed case and never match (D3); pass
    ``fix_gender_case=True`` to compare in upper case."""
    if fix_gender_case:
        pairs = [(("F", "FEMALE"), "Female"), (("M", "MALE"), "Male")]
    else:
        pairs = [(("F", "Female"), "Female"), (("M", "Male"), "Male")]
    return map_codes(c, pairs, UNKNOWN)


def standardise_country(c) -> Column:
    """Country code -> name; blank or NULL -> 'Unkown'; other values trimmed (E5)."""
    t = F.trim(col(c))
    expr = None
    for code, name in COUNTRY_CODES.items():
        expr = F.when(t == code, F.lit(name)) if expr is None else expr.when(t == code, F.lit(name))
    return expr.when((t == "") | col(c).isNull(), F.lit(COUNTRY_UNKNOWN)).otherwise(t)


def split_product_key(df: DataFrame, key: str = "prd_key") -> DataFrame:
    """``cat_id = REPLACE(SUBSTRING(key,1,5),'-','_')``, key = rest after position 7."""
    k = F.col(key)
    return df.withColumns({
        "cat_id": F.replace(F.substring(k, 1, 5), F.lit("-"), F.lit("_")),
        key: F.substring(k, F.lit(7), F.length(k)),
    })


def repair_customer_id(c) -> Column:
    """Strip the legacy ``NAS`` prefix."""
    return strip_prefix(c, "NAS")


def repair_location_id(c) -> Column:
    """Remove dashes from location keys."""
    return remove_chars(c, "-")


def add_valid_to(df: DataFrame, key: str, start: str, out: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Validity interval end = next version's start - 1 day, as a date.

    The LEAD runs on the start column as given (timestamp in bronze); the
    result is cast to date, exactly like ``CAST(LEAD(start) - 1 day AS DATE)``.
    ``tiebreak`` columns make the order total when two versions share a start.

    A key's versions are split by the month of their start, so that even a key that holds most rows is spread over
    tasks: one exchange on (key, month) gives each row its successor within the month, and the last
    row of a month takes the first start of the key's next month from a table with one row per key and month.
    """
    order = [F.col(start).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    part = ["_no_key", "_key", "_month"]
    rows = df.withColumns({
        "_no_key": F.col(key).isNull(), "_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
        # Versions without a start come last.
        "_month": F.coalesce(F.year(start) * 12 + F.month(start), F.lit((1 << 31) - 1))})
    within = Window.partitionBy(*part).orderBy(*order)
    rows = rows.withColumns({"_next": F.lead(start).over(within), "_last": F.lead(F.lit(1)).over(within).isNull()})
    heads = rows.groupBy(*part).agg(F.min(start).alias("_first"))
    heads = heads.withColumn("_after", F.lead("_first").over(Window.partitionBy("_no_key", "_key").orderBy("_month")))
    rows = rows.join(heads.drop("_first"), part, "left")
    following = F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_next"))
    return rows.withColumn(out, (following - F.expr("INTERVAL 1 DAY")).cast("date")) \
        .drop(*part, "_next", "_last", "_after")


def zero_if_null(c) -> Column:
    """``COALESCE(c, 0)``."""
    return F.coalesce(col(c), F.lit(0))


def repair_sales(df: DataFrame, sales: str = "sls_sales", qty: str = "sls_quantity",
                 price: str = "sls_price") -> DataFrame:
    """Derive sales and price from each other (E11, E12), one projection.

    sales := qty * |price| when sales is NULL, <= 0 or != qty * |price|
    price := sales div NULLIF(qty, 0) when price is NULL or <= 0, using the
    *original* sales (three-valued logic kept: a NULL comparison keeps sales).
    """
    s, q, p = F.col(sales), F.col(qty), F.col(price)
    expected = q * F.abs(p)
    new_sales = F.when(s.isNull() | (s <= 0) | (s != expected), expected).otherwise(s)
    new_price = F.when(p.isNull() | (p <= 0), int_div(s, F.nullif(q, F.lit(0)))).otherwise(p)
    return df.withColumns({sales: new_sales, price: new_price.cast(df.schema[price].dataType)})


def encoded_dates_to_date(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Integer YYYYMMDD columns -> DATE."""
    return df.withColumns({c: int_to_date(c) for c in cols})

