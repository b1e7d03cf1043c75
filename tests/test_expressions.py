import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierwise.functions import expressions as X
from tierwise.operators import analytics as A
from tierwise.plans.gold import prefer_master

D = dt.date


def one(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_whole_months(spark):
    data = [(D(2013, 2, 28), D(2013, 1, 31)), (D(2014, 1, 15), D(2013, 1, 15)), (D(2014, 1, 14), D(2013, 1, 15)),
            (D(2013, 1, 31), D(2013, 3, 1)), (None, D(2013, 1, 1)), (D(2013, 1, 1), None)]
    got = one(spark, data, "a date, b date", X.whole_months("a", "b"))
    assert got == [0, 12, 11, -1, None, None]


def test_age_years_truncates(spark):
    data = [(D(2002, 1, 1), D(1971, 10, 6)), (D(2002, 1, 1), D(1982, 1, 1)), (D(2002, 1, 1), D(2003, 3, 1))]
    assert one(spark, data, "a date, b date", X.age_years("a", "b")) == [30, 20, -1]


def test_int_to_date(spark):
    data = [(20101229,), (0,), (5489,), (None,), (20139999,), (-1234567,)]
    got = one(spark, data, "d int", X.int_to_date("d"))
    assert got == [D(2010, 12, 29), None, None, None, None, None]


def test_concat_name_and_percent(spark):
    got = one(spark, [(None, None), ("Ann", None), ("Ann", "Lee")], "f string, l string", X.full_name("f", "l"))
    assert got == [" ", "Ann ", "Ann Lee"]
    got = one(spark, [(396, 1000), (1, 3), (2, 3), (-1, 8), (None, 5)], "a bigint, b bigint", X.pct_text("a", "b"))
    assert got == ["39.60%", "33.33%", "66.67%", "-12.50%", "%"]


def test_round_half_away_from_zero(spark):
    got = one(spark, [(1, 8), (-1, 8), (7, 2)], "a bigint, b bigint", X.round2(X.exact_ratio("a", "b")))
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("3.50")]


def test_int_div_truncates(spark):
    assert one(spark, [(7, 2), (-7, 2), (7, 0)], "a int, b int", X.int_div("a", F.nullif(F.col("b"), F.lit(0)))) \
        == [3, -3, None]


def test_bands(spark):
    got = one(spark, [(v,) for v in (99, 100, 500, 501, 1000, 1001, None)], "c int", A.cost_range(F.col("c")))
    assert got == ["Below 100", "100-500", "100-500", "501-1000", "501-1000", "Above 1000", "Above 1000"]
    got = one(spark, [(v,) for v in (19, 20, 29, 50, None)], "c int", A.age_bracket(F.col("c")))
    assert got == ["Under 20", "20-29", "20-29", "50 and Above", "50 and Above"]
    got = one(spark, [(v,) for v in (50000, 50001, 10000, 9999)], "c bigint", A.product_tier(F.col("c")))
    assert got == ["Mid Performer", "High Performer", "Mid Performer", "Low Performer"]


def test_customer_tier(spark):
    data = [(12, 5000), (12, 4999), (11, 9999), (None, 9999)]
    got = one(spark, data, "l int, s bigint", A.customer_tier(F.col("l"), F.col("s")))
    assert got == ["VIP Customer", "Regular Customer", "New Customer", "New Customer"]


def test_gender_precedence(spark):
    data = [("Male", "Female"), ("Unknown", "Female"), ("Unknown", None), (None, "Male")]
    got = one(spark, data, "m string, e string", prefer_master(F.col("m"), F.col("e")))
    assert got == ["Male", "Female", "Unknown", "Male"]


def test_period_change_first_period(spark):
    df = spark.createDataFrame([(D(2010, 1, 1), 10), (D(2011, 1, 1), 5), (D(2012, 1, 1), 5)], "p date, v bigint")
    out = A.period_change(df, "p", "v").orderBy("p").collect()
    assert [(r.prev_sales, r.difference_sales, r.prev_change) for r in out] == \
        [(None, None, "No change"), (10, -5, "Decrease"), (5, 0, "No change")]


def test_rolling_three(spark):
    df = spark.createDataFrame([(D(2010, m, 1), v) for m, v in zip(range(1, 5), (10, 20, 60, 1))], "p date, v bigint")
    got = [r.r for r in A.rolling_avg(df, "p", "v", 3, "r").orderBy("p").collect()]
    assert got == [Decimal("10.00"), Decimal("15.00"), Decimal("30.00"), Decimal("27.00")]


def test_running_total_reset(spark):
    df = spark.createDataFrame([(D(2010, 11, 1), 1), (D(2010, 12, 1), 2), (D(2011, 1, 1), 4)], "p date, v bigint")
    got = [r.running_total for r in A.running_total(df, "p", "v", reset_by=F.year("p")).orderBy("p").collect()]
    assert got == [1, 3, 4]


def test_vs_average(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 31)], "k string, y int, v bigint")
    out = A.vs_average(df, ["k"], "v").orderBy("y").collect()
    assert [(r.avg_sales, r.difference_avg, r.avg_change) for r in out] == [
        (Decimal("20.33"), Decimal("-10.33"), "Below Avg"), (Decimal("20.33"), Decimal("-0.33"), "Below Avg"),
        (Decimal("20.33"), Decimal("10.67"), "Above Avg")]


def test_average_order_value_truncates_then_rounds(spark):
    from tierwise.plans.reports import _average_per_order
    df = spark.createDataFrame([(7, 2), (7, 0)], "s bigint, o bigint")
    assert [r[0] for r in df.select(_average_per_order("s", "o", False)).collect()] == [Decimal("3.00"),
                                                                                         Decimal("0.00")]
    assert [r[0] for r in df.select(_average_per_order("s", "o", True)).collect()][0] == Decimal("3.50")


def test_sales_lines_are_built_without_text_formatting_per_row(spark):
    from tierwise.sources import testdata
    orders = spark.createDataFrame([(1, 7, "1998-02-03"), (2, None, None)], "o_orderkey long, o_custkey long, o_orderdate string") \
        .withColumn("o_orderdate", F.to_date("o_orderdate"))
    part = spark.createDataFrame([(1, "red small gear")], "p_partkey long, p_name string")
    lines = spark.createDataFrame([(1, 1, 2.0, 10.0, 0.06, 0.01, "1998-02-28"), (2, 9, 2.0, 10.0, 0.06, 0.01, None)],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, "
                                  "l_tax double, l_shipdate string").withColumn("l_shipdate", F.to_date("l_shipdate"))
    got = testdata.crm_sales_details(lines, orders, part)
    assert [tuple(r)[:6] for r in got.orderBy("sls_ord_num").collect()] == [
        ("SO1", "RED-SMALL-GEAR", 7, 19980203, 19980228, 19980504), ("SO2", None, None, None, None, None)]
    # The part's number is made once a part, below the join.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("upper(") > plan.index("Join")


def test_date_to_int_and_customer_number_equal_the_text_forms(spark):
    from tierwise.sources.testdata import _customer_number
    days = spark.createDataFrame([("0001-01-01",), ("0999-12-31",), ("2024-02-29",), ("9999-12-31",), (None,)], "t string") \
        .withColumn("d", F.to_date("t"))
    assert days.where(~X.date_to_int("d").eqNullSafe(F.date_format("d", "yyyyMMdd").cast("int"))).count() == 0
    keys = spark.createDataFrame([(0,), (7,), (12345678,), (123456789012,), (-5,), (None,)], "k long")
    assert keys.where(~_customer_number(F.col("k")).eqNullSafe(F.format_string("AW%08d", "k"))).count() == 0
