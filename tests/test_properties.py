"""Property tests against brute-force Python models."""
import calendar
import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwise.functions import expressions as X
from tierwise.operators.cleansing import latest_per_key

dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


def pg_age_months(a: dt.date, b: dt.date) -> int:
    """PostgreSQL AGE(a, b) -> years*12 + months, by field-wise subtraction with day borrow."""
    if a < b:
        return -pg_age_months(b, a)
    months = (a.year - b.year) * 12 + (a.month - b.month)
    if a.day < b.day:
        months -= 1
    return months


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=60))
def test_whole_months_matches_model(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(X.whole_months("a", "b")).collect()]
    assert got == [pg_age_months(a, b) for a, b in pairs]


def int_date_model(v):
    if v is None or v == 0 or len(str(v)) != 8:
        return None
    try:
        return dt.datetime.strptime(str(v), "%Y%m%d").date()
    except ValueError:
        return None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-99999999, 99999999),
                          st.builds(lambda d: int(d.strftime("%Y%m%d")), dates)), min_size=1, max_size=60))
def test_int_to_date_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [r[0] for r in df.select(X.int_to_date("v")).collect()]
    assert got == [int_date_model(v) for v in values]


def test_latest_per_key_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 3, 4, 5]), rnd.choice([None, dt.date(2020, 1, rnd.randint(1, 28))]),
             rnd.randint(0, 1000)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, d date, v int")
    got = {r.k: (r.d, r.v) for r in latest_per_key(df, ["k"], [F.col("d").desc_nulls_first()],
                                                   [F.col("v").asc_nulls_last()]).collect()}
    want = {}
    for k, d, v in rows:
        if k is None:
            continue
        # NULL date first, then newest date, then smallest v
        key = (0 if d is None else 1, -(d.toordinal() if d else 0), v)
        if k not in want or key < want[k][0]:
            want[k] = (key, (d, v))
    assert got == {k: val for k, (_, val) in want.items()}


def test_month_end_borrow_cases():
    assert pg_age_months(dt.date(2013, 2, 28), dt.date(2013, 1, 31)) == 0
    assert calendar.isleap(2012)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=12),
       st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=6))
def test_not_in_matches_sql_semantics(spark, child, parent):
    from tierwise.operators.quality import orphans_not_in
    c = spark.createDataFrame([(v,) for v in child], "k int")
    p = spark.createDataFrame([(v,) for v in parent], "pk int")
    got = sorted(orphans_not_in(c, "k", p, "pk").collect(), key=lambda r: (r.k is None, r.k or 0))
    if not parent:
        want = child
    elif any(v is None for v in parent):
        want = []
    else:
        want = [v for v in child if v is not None and v not in parent]
    assert [r.k for r in got] == sorted(want, key=lambda v: (v is None, v or 0))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**9)), min_size=1, max_size=40))
def test_cent_rounding_matches_decimal_model(spark, pairs):
    from decimal import ROUND_HALF_UP, Decimal, localcontext
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = df.select(X.round2(X.exact_ratio("a", "b")).alias("r"), X.pct_text("a", "b").alias("p")).collect()
    with localcontext() as ctx:
        ctx.prec = 60
        for (a, b), row in zip(pairs, got):
            q = (Decimal(a) / Decimal(b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            p = (Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            p = abs(p) if p == 0 else p   # numeric has no negative zero: -0.004 rounds to 0.00
            assert row.r == q and row.p == f"{p}%"


def test_whole_months_matches_duckdb_age(spark):
    """Cross-engine: Spark's whole months equals DuckDB's own AGE() on random pairs, month ends included."""
    import duckdb
    rnd = random.Random(5)
    base = dt.date(1990, 1, 1)
    pairs = []
    for _ in range(3000):
        a = base + dt.timedelta(days=rnd.randint(0, 15000))
        b = base + dt.timedelta(days=rnd.randint(0, 15000))
        pairs.append((a, b))
    pairs += [(dt.date(2013, 2, 28), dt.date(2013, 1, 31)), (dt.date(2012, 2, 29), dt.date(2011, 2, 28)),
              (dt.date(2013, 3, 31), dt.date(2013, 2, 28)), (dt.date(2013, 1, 31), dt.date(2013, 3, 1))]
    got = [r[0] for r in spark.createDataFrame(pairs, "a date, b date").select(X.whole_months("a", "b")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (i INTEGER, a DATE, b DATE)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = [r[0] for r in con.execute(
        "SELECT CAST(date_part('year', age(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP))) * 12 "
        "+ date_part('month', age(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP))) AS INTEGER) FROM p ORDER BY i").fetchall()]
    assert got == want
