"""The analytic queries Q1-Q19 over the gold star schema.

Each function takes the gold frames (``fact_sales``, ``dim_customers``,
``dim_products``) and returns a DataFrame with the source warehouse's columns.
Joins to a dimension are done *after* pre-aggregating the fact on the
surrogate key wherever the grouping is functionally dependent on it, so the
shuffle carries one row per key (and period) instead of one per sale.

The source groups some questions on the dimension's key after a LEFT JOIN.
Grouping on the fact's key first is the same thing here: every non-NULL fact
key was looked up from the same refresh's dimension (check K9 verifies it),
and NULL fact keys form one NULL group either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import full_name
from ..operators import analytics as A

Gold = dict[str, DataFrame]


def _dated(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("order_date").isNotNull())


def _totals() -> dict:
    return dict(total_sales=F.sum("sales_amount"),
                total_customer=F.count_distinct("customer_key"),
                total_quantity=F.sum("quantity"))


def q01_monthly_sales(g: Gold) -> DataFrame:
    return A.period_rollup(g["fact_sales"], "order_date", "month", _totals()) \
        .orderBy(F.col("order_date").asc_nulls_last())


def q02_yearly_sales(g: Gold) -> DataFrame:
    return A.period_rollup(g["fact_sales"], "order_date", "year", _totals()) \
        .orderBy(F.col("order_date").asc_nulls_last())


def _period_sales(g: Gold, grain: str, out: str) -> DataFrame:
    return A.period_rollup(g["fact_sales"], "order_date", grain, {"total_sales": F.sum("sales_amount")}, out=out)


def q03_yoy_change(g: Gold) -> DataFrame:
    return A.period_change(_period_sales(g, "year", "order_year"), "order_year", "total_sales") \
        .orderBy(F.col("order_year").asc_nulls_last())


def q04_mom_change(g: Gold) -> DataFrame:
    # The source query names the month column ``order_year``.
    return A.period_change(_period_sales(g, "month", "order_year"), "order_year", "total_sales") \
        .orderBy(F.col("order_year").asc_nulls_last())


def q05_running_total_monthly(g: Gold) -> DataFrame:
    return A.running_total(_period_sales(g, "month", "order_month"), "order_month", "total_sales") \
        .orderBy(F.col("order_month").asc_nulls_last())


def q06_running_total_yearly_reset(g: Gold) -> DataFrame:
    return A.running_total(_period_sales(g, "month", "order_month"), "order_month", "total_sales",
                           reset_by=F.year("order_month")).orderBy(F.col("order_month").asc_nulls_last())


def q07_running_total_yearly(g: Gold) -> DataFrame:
    return A.running_total(_period_sales(g, "year", "order_year"), "order_year", "total_sales") \
        .orderBy(F.col("order_year").asc_nulls_last())


def q08_rolling_3_month_avg(g: Gold) -> DataFrame:
    return A.rolling_avg(_period_sales(g, "month", "order_month"), "order_month", "total_sales", 3,
                         "rolling_3_month_avg").orderBy(F.col("order_month").asc_nulls_last())


def q09_cost_ranges(g: Gold) -> DataFrame:
    p = g["dim_products"].select("product_key", A.cost_range(F.col("cost")).alias("cost_range"))
    return p.groupBy("cost_range").agg(F.count("product_key").alias("total_products")) \
        .orderBy(F.col("total_products").desc_nulls_first(), "cost_range")


def customer_spending(g: Gold, value: str = "total_spending") -> DataFrame:
    """Per customer (inner join to the dimension): spend, first/last order, lifespan, tier."""
    per_key = g["fact_sales"].groupBy("customer_key").agg(
        F.sum("sales_amount").alias(value),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"))
    # Inner join to the dimension only filters (no dimension column is used, keys are unique): a semi join.
    c = g["dim_customers"].select("customer_key")
    j = per_key.join(c, "customer_key", "left_semi")
    j = j.withColumn("lifespan", A.lifespan_months(F.col("first_order"), F.col("last_order")))
    return j.withColumn("customer_tier", A.customer_tier(F.col("lifespan"), F.col(value)))


def q10_customer_tiers(g: Gold) -> DataFrame:
    return customer_spending(g).groupBy("customer_tier") \
        .agg(F.count("customer_key").alias("total_customers")) \
        .orderBy(F.col("total_customers").desc_nulls_first(), "customer_tier")


def _top_customers(g: Gold, measure: str, alias: str) -> DataFrame:
    per_key = _dated(g["fact_sales"]).groupBy(F.year("order_date").alias("order_year"), "customer_key") \
        .agg(F.sum(measure).alias(alias))
    # Rank on the fact alone: only five rows a year meet the dimension.
    ranked = A.top_k(per_key, ["order_year"], [F.col(alias).desc_nulls_first(), F.col("customer_key").asc_nulls_last()],
                     5, "rank")
    c = g["dim_customers"].select("customer_key", full_name("first_name", "last_name").alias("customer_name"))
    named = ranked.join(c, "customer_key", "left") \
        .withColumn("customer_name", F.coalesce("customer_name", full_name(F.lit(None), F.lit(None))))
    return named.select("order_year", "customer_key", "customer_name", alias, "rank") \
        .orderBy("order_year", "rank")


def q11_top5_customers_by_sales(g: Gold) -> DataFrame:
    return _top_customers(g, "sales_amount", "total_amount")


def q12_top5_customers_by_quantity(g: Gold) -> DataFrame:
    return _top_customers(g, "quantity", "total_quantity")


def _product_attrs(g: Gold, *cols: str) -> DataFrame:
    return g["dim_products"].select("product_key", *cols)


def q13_category_sales(g: Gold) -> DataFrame:
    per_key = _dated(g["fact_sales"]).groupBy("product_key").agg(
        F.sum("sales_amount").alias("s"), F.sum("quantity").alias("q"))
    j = per_key.join(_product_attrs(g, "category", "subcategory"), "product_key", "left")
    return j.groupBy("category", "subcategory").agg(F.sum("s").alias("total_amount"),
                                                    F.sum("q").alias("total_quantity")) \
        .orderBy(F.col("category").asc_nulls_last(), F.col("total_amount").desc_nulls_first())


def q14_product_yearly_performance(g: Gold) -> DataFrame:
    per_key = _dated(g["fact_sales"]).groupBy(F.year("order_date").alias("order_year"), "product_key") \
        .agg(F.sum("sales_amount").alias("s"))
    j = per_key.join(_product_attrs(g, "product_name"), "product_key", "left")
    yearly = j.groupBy("order_year", "product_name").agg(F.sum("s").alias("current_sales"))
    out = A.vs_average(yearly, ["product_name"], "current_sales")
    out = A.period_change(out, "order_year", "current_sales", ["product_name"], prev="prev_year_sales")
    return out.select("order_year", "product_name", "current_sales", "avg_sales", "difference_avg", "avg_change",
                      "prev_year_sales", "difference_sales", "prev_change") \
        .orderBy(F.col("product_name").asc_nulls_last(), F.col("order_year").asc_nulls_last())


def q15_profit_margins(g: Gold) -> DataFrame:
    f = g["fact_sales"]
    qty, price = F.col("quantity").cast("bigint"), F.col("price").cast("bigint")
    # Pre-aggregate per product; profit = sum(q*p) - cost * sum(q) over rows where q*p is defined.
    per_key = f.groupBy("product_key").agg(
        F.sum("sales_amount").alias("s"), F.sum("quantity").alias("q"), F.max("price").alias("mp"),
        F.sum(qty * price).alias("qp"), F.sum(F.when(price.isNotNull(), qty)).alias("qd"))
    j = per_key.join(_product_attrs(g, "category", "subcategory", "product_name", "cost"), "product_key", "left")
    j = j.withColumn("profit_part", F.col("qp") - F.col("cost").cast("bigint") * F.col("qd"))
    agg = A.profit_margin(j, ["category", "subcategory", "product_name"], "s", "q", "mp", "cost", "profit_part")
    return agg.orderBy(*[F.col(c).asc_nulls_last() for c in ("category", "subcategory", "product_name")])


def _share(per_group: DataFrame, key: str) -> DataFrame:
    return A.share_of_total(per_group, key, "total_amount") \
        .orderBy(F.col("total_amount").desc_nulls_first(), F.col(key).asc_nulls_last())


def q16_category_share(g: Gold) -> DataFrame:
    per_key = g["fact_sales"].groupBy("product_key").agg(F.sum("sales_amount").alias("s"))
    j = per_key.join(_product_attrs(g, "category"), "product_key", "left")
    return _share(j.groupBy("category").agg(F.sum("s").alias("total_amount")), "category")


def _customer_share(g: Gold, attr: str) -> DataFrame:
    per_key = g["fact_sales"].groupBy("customer_key").agg(F.sum("sales_amount").alias("s"))
    j = per_key.join(g["dim_customers"].select("customer_key", attr), "customer_key", "left")
    return _share(j.groupBy(attr).agg(F.sum("s").alias("total_amount")), attr)


def q17_country_share(g: Gold) -> DataFrame:
    return _customer_share(g, "country")


def q18_gender_share(g: Gold) -> DataFrame:
    return _customer_share(g, "gender")


def q19_tier_share(g: Gold) -> DataFrame:
    per_tier = customer_spending(g, "total_amount").groupBy("customer_tier").agg(
        F.count("customer_key").alias("total_customers"), F.sum("total_amount").alias("total_amount"))
    out = A.share_of_total(per_tier, "customer_tier", "total_amount").drop("overall_amount")
    # Ordered by the percentage *text*, as the source query does.
    return out.orderBy(F.col("percentage_of_total").desc_nulls_first())
