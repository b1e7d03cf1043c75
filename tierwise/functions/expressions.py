"""Column expressions shared by every layer.

All helpers return ``pyspark.sql.Column`` built from JVM-side functions, so they
stay inside whole-stage codegen. Semantics follow the source warehouse
(PostgreSQL): NULL ordering is always spelled out, text concatenation skips
NULLs, integer division truncates, ``ROUND(numeric, 2)`` rounds half away from
zero on exact decimals.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Exact decimal used for every division whose result is rounded to cents.
# decimal(20,0) / decimal(20,0) keeps 18 fractional digits in Spark.
EXACT = "decimal(20,0)"
MONEY = "decimal(18,2)"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- text
def clean_text(c: ColumnOrName) -> Column:
    """TRIM + UPPER, the normalisation applied before every code lookup."""
    return F.upper(F.trim(col(c)))


def concat_skip_null(*parts: ColumnOrName) -> Column:
    """PostgreSQL CONCAT: NULL arguments are treated as empty strings."""
    return F.concat_ws("", *[col(p) for p in parts])


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``CONCAT(first, ' ', last)``; two NULL names give a single space."""
    return concat_skip_null(first, F.lit(" "), last)


def map_codes(c: ColumnOrName, mapping: Mapping[str, str] | Sequence[tuple[Iterable[str], str]],
              default: str | None, normalise: bool = True) -> Column:
    """Code -> label lookup as a CASE chain.

    ``mapping`` is either ``{code: label}`` or a list of ``(codes, label)``
    pairs; codes are compared to ``TRIM(UPPER(c))`` when ``normalise``.
    Anything unmatched (including NULL) becomes ``default``.
    """
    key = clean_text(c) if normalise else col(c)
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    expr = None
    for codes, label in pairs:
        codes = [codes] if isinstance(codes, str) else list(codes)
        cond = key == F.lit(codes[0]) if len(codes) == 1 else key.isin(codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    default_col = F.lit(default)
    return default_col if expr is None else expr.otherwise(default_col)


def strip_prefix(c: ColumnOrName, prefix: str) -> Column:
    """The text without ``prefix``, where it starts with it."""
    c = col(c)
    return F.when(c.startswith(prefix), F.substring(c, F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def remove_chars(c: ColumnOrName, chars: str) -> Column:
    """``REPLACE(c, chars, '')``."""
    return F.replace(col(c), F.lit(chars), F.lit(""))


# --------------------------------------------------------------------------- dates
def int_to_date(c: ColumnOrName) -> Column:
    """Integer ``YYYYMMDD`` -> date.

    0 or a value whose text is not 8 characters gives NULL; 8-character
    garbage (e.g. 20139999) also gives NULL instead of failing the load.
    Pure integer arithmetic (no per-row text formatting or parsing): the
    8-character test is a numeric range and the date is built from its parts.
    """
    v = col(c)
    eight_chars = v.between(10_000_000, 99_999_999) | v.between(-9_999_999, -1_000_000)
    built = F.try_make_timestamp_ntz(int_div(v, F.lit(10_000)).cast("int"),
                                     (int_div(v, F.lit(100)) % 100).cast("int"),
                                     (v % 100).cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.when((v == 0) | ~eight_chars, F.lit(None).cast("date")).otherwise(built)


def date_to_int(c: ColumnOrName) -> Column:
    """Date -> integer ``YYYYMMDD`` (inverse of :func:`int_to_date`)."""
    d = col(c)
    # Text only for years before 1, which it counts backwards.
    return F.when(F.year(d) > 0, F.year(d) * 10_000 + F.month(d) * 100 + F.dayofmonth(d)) \
        .otherwise(F.date_format(d, "yyyyMMdd").cast("int"))


def whole_months(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole months between two dates, PostgreSQL ``AGE`` style.

    ``EXTRACT(YEAR FROM AGE(a, b)) * 12 + EXTRACT(MONTH FROM AGE(a, b))``:
    months borrow when the day of month of the later date is smaller.
    Symmetric in sign; NULL if either side is NULL.
    """
    a, b = col(later).cast("date"), col(earlier).cast("date")
    hi, lo = F.greatest(a, b), F.least(a, b)
    months = ((F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo)
              - F.when(F.dayofmonth(hi) < F.dayofmonth(lo), 1).otherwise(0))
    signed = F.when(a >= b, months).otherwise(-months)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("int")).otherwise(signed)


def age_years(as_of: ColumnOrName, birth: ColumnOrName) -> Column:
    """``EXTRACT(YEAR FROM AGE(as_of, birth))``: whole years, truncated."""
    return int_div(whole_months(as_of, birth), F.lit(12)).cast("int")


def null_future_dates(c: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Dates after ``as_of`` become NULL."""
    c = col(c)
    return F.when(c > col(as_of), F.lit(None).cast("date")).otherwise(c)


def as_of_col(as_of) -> Column:
    """Normalise an ``as_of`` argument (None, str, date or Column) to a date column."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def period_start(c: ColumnOrName, grain: str) -> Column:
    """``DATE_TRUNC(grain, d)::date`` for grain in month/year."""
    fmt = {"month": "MM", "year": "YEAR", "quarter": "QUARTER", "week": "WEEK"}[grain]
    return F.trunc(col(c).cast("date"), fmt)


# --------------------------------------------------------------------------- numbers
def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integer division that truncates toward zero, like ``bigint / bigint``."""
    return F.call_function("div", col(a), col(b))


def exact_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Exact decimal quotient (18 fractional digits), T7."""
    return col(num).cast(EXACT) / col(den).cast(EXACT)


def round2(c: ColumnOrName) -> Column:
    """``ROUND(numeric, 2)`` returned as ``decimal(18,2)``."""
    return F.round(col(c), 2).cast(MONEY)


def pct_text(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``CONCAT(ROUND(num / den * 100, 2), '%')`` with exact decimals.

    CONCAT skips NULL, so a NULL ratio gives ``'%'``."""
    return concat_skip_null(round2(exact_ratio(num, den) * 100).cast("string"), F.lit("%"))


def band(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Numeric banding (R5): first matching ``(predicate, label)`` wins, else ``default``.

    A NULL input fails every predicate and falls to ``default`` (D11).
    """
    expr = None
    for pred, label in rules:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return expr.otherwise(F.lit(default))


def change_label(diff: ColumnOrName, up: str = "Increase", down: str = "Decrease",
                 flat: str = "No change") -> Column:
    """Direction label of a difference; a NULL difference is ``flat``."""
    d = col(diff)
    return F.when(d > 0, F.lit(up)).when(d < 0, F.lit(down)).otherwise(F.lit(flat))
