import datetime as dt
from decimal import Decimal

from tierwise.plans import reports as R

D = dt.date


def _gold(spark, fact_rows):
    fact = spark.createDataFrame(fact_rows, "order_number string, product_key bigint, customer_key bigint, "
                                            "order_date date, shipping_date date, due_date date, sales_amount int, "
                                            "quantity int, price int")
    prod = spark.createDataFrame([(1, 11, "P-1", "p one", "C", "Cat", "Sub", "No", 5, "Road", D(2010, 1, 1))],
                                 "product_key bigint, product_id int, product_number string, product_name string, "
                                 "category_id string, category string, subcategory string, maintenance string, "
                                 "cost int, product_line string, start_date date")
    cust = spark.createDataFrame([(1, 7, "AW7", "Ann", None, "Female", D(1980, 6, 15), "Single", "Germany", None)],
                                 "customer_key bigint, customer_id int, customer_number string, first_name string, "
                                 "last_name string, gender string, birthdate date, marital_status string, "
                                 "country string, create_date date")
    return {"fact_sales": fact, "dim_products": prod, "dim_customers": cust}


def test_product_report_average_selling_price(spark):
    d = D(2010, 5, 1)
    rows = [("SO1", 1, 1, d, None, None, 7, 2, 3), ("SO1", 1, 1, D(2011, 6, 2), None, None, 3, 3, 1),
            ("SO2", 1, 1, d, None, None, None, 2, 1), ("SO3", 1, 1, d, None, None, 5, 0, None),
            ("SO4", None, 1, d, None, None, 9, 4, 2), ("SO5", 1, 1, None, None, None, 100, 1, 100)]
    out = {r.product_key: r for r in R.product_report(_gold(spark, rows), "2012-01-01").collect()}
    one = out[1]
    assert one.avg_selling_price == Decimal("2.25")       # avg(7/2, 3/3); NULL sales and qty 0 skipped
    assert (one.total_orders, one.total_sales, one.lifespan, one.recency) == (3, 15, 13, 6)
    assert one.avg_order_revenue == Decimal("5.00") and one.avg_monthly_spend == Decimal("1.15")
    assert out[None].avg_selling_price == Decimal("2.25")  # unmatched fact key forms one NULL group


def test_customer_report_kpis(spark):
    rows = [("SO1", 1, 1, D(2010, 5, 1), None, None, 7, 2, 3), ("SO2", 1, 1, D(2011, 6, 2), None, None, 5000, 3, 1)]
    r = R.customer_report(_gold(spark, rows), "2012-01-01").first()
    assert (r.customer_name, r.age, r.age_bracket, r.customer_tier) == ("Ann ", 31, "30-39", "VIP Customer")
    assert (r.total_orders, r.total_products, r.lifespan, r.recency) == (2, 1, 13, 6)
    assert r.avg_order_value == Decimal("2503.00") and r.avg_monthly_spend == Decimal("385.15")
    exact = R.customer_report(_gold(spark, rows), "2012-01-01", exact_average=True).first()
    assert exact.avg_order_value == Decimal("2503.50")


def test_profit_margin_operator_matches_preaggregated_query(spark):
    """R9 on joined rows equals Q15, which pre-aggregates per product before the join."""
    from tierwise.operators.analytics import profit_margin
    from tierwise.plans.queries import q15_profit_margins
    from tierwise.plans.warehouse import warehouse_for
    sf = "/root/testdata/sf0.001"
    g = warehouse_for(spark, sf).gold
    p = g["dim_products"].select("product_key", "category", "subcategory", "product_name", "cost")
    joined = g["fact_sales"].join(p, "product_key", "left")
    keys = ["category", "subcategory", "product_name"]
    a = {tuple(r[k] for k in keys): tuple(r) for r in profit_margin(joined, keys).collect()}
    b = {tuple(r[k] for k in keys): tuple(r[c] for c in profit_margin(joined, keys).columns)
         for r in q15_profit_margins(g).collect()}
    assert a == b and len(a) > 0
