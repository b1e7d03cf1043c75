"""Every registered query against its DuckDB oracle on the smallest shared tables."""
import os

import pytest

from compare import digest, oracle_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables absent")


def test_all_registered_queries_match_oracle(spark):
    import __spark_entry__ as E
    from tierwise.plans.registry import all_queries
    con = oracle_connection(SF)
    sql = E.oracle_sql()
    bad = []
    for name, fn in all_queries().items():
        df = fn(spark, SF)
        srows = [tuple(r) for r in df.collect()]
        assert name in sql, name
        res = con.execute(sql[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        if sorted(df.columns) != sorted(ocols) or digest(df.columns, srows)[0] != digest(ocols, orows)[0]:
            bad.append(name)
    assert bad == []


# Columns that each question's ORDER BY names; rows alike in them may come in any order.
ORDERED_BY = {
    "q01_monthly_sales": ["order_date"], "q02_yearly_sales": ["order_date"], "q03_yoy_change": ["order_year"],
    "q04_mom_change": ["order_year"], "q05_running_total_monthly": ["order_month"],
    "q06_running_total_yearly_reset": ["order_month"], "q07_running_total_yearly": ["order_year"],
    "q08_rolling_3_month_avg": ["order_month"], "q09_cost_ranges": ["total_products"],
    "q10_customer_tiers": ["total_customers"], "q11_top5_customers_by_sales": ["order_year", "rank"],
    "q12_top5_customers_by_quantity": ["order_year", "rank"], "q13_category_sales": ["category", "total_amount"],
    "q14_product_yearly_performance": ["product_name", "order_year"],
    "q15_profit_margins": ["category", "subcategory", "product_name"], "q16_category_share": ["total_amount"],
    "q17_country_share": ["total_amount"], "q18_gender_share": ["total_amount"], "q19_tier_share": ["percentage_of_total"],
}


def test_ordered_questions_return_their_rows_in_order(spark):
    import __spark_entry__ as E
    from tierwise.plans.registry import all_queries
    con, sql, qs = oracle_connection(SF), E.oracle_sql(), all_queries()
    assert set(ORDERED_BY) == {n for n in qs if n[0] == "q" and n[1:3].isdigit() and n[1:3] <= "19"}
    bad = []
    for name, keys in ORDERED_BY.items():
        got = [tuple(str(r[k]) for k in keys) for r in qs[name](spark, SF).collect()]
        res = con.execute(sql[name])
        at = [[d[0] for d in res.description].index(k) for k in keys]
        if got != [tuple(str(r[i]) for i in at) for r in res.fetchall()]:
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["order_month", "total_sales", "rolling_3_month_avg"]
    assert df.count() > 0


def test_publish_catalog_views(spark):
    from tierwise.plans.warehouse import warehouse_for
    wh = warehouse_for(spark, SF)
    names = wh.publish("2002-01-01")
    assert "gold.fact_sales" in names and "silver.crm_cust_info" in names
    # The source warehouse's SQL style runs against the published views.
    got = spark.sql("""
        SELECT DATE_TRUNC('year', order_date)::date AS order_date, SUM(sales_amount) AS total_sales
        FROM gold.fact_sales WHERE order_date IS NOT NULL GROUP BY 1 ORDER BY 1""").collect()
    want = [(r.order_date, r.total_sales) for r in
            __import__("tierwise.plans.queries", fromlist=["q"]).q02_yearly_sales(wh.gold).collect()]
    assert [(r.order_date, r.total_sales) for r in got] == want
    assert spark.table("gold.report_customers").count() > 0
