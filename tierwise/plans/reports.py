"""Customer and product report views (Q20, Q21).

Both aggregate the fact on its surrogate key first (one row per customer /
product, two exact distinct counts each, all from one scan once the rows are counted), then attach the dimension
attributes with a key-to-key join and compute the KPIs row by row.
``as_of`` replaces the source's ``NOW()`` so results are reproducible.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    EXACT, age_years, as_of_col, exact_ratio, full_name, int_div, round2, whole_months,
)
from ..operators import analytics as A

REPORT_CUSTOMERS = ["customer_key", "customer_number", "customer_name", "age", "age_bracket", "customer_tier",
                    "last_order_date", "recency", "total_orders", "total_sales", "total_quantity", "total_products",
                    "lifespan", "avg_order_value", "avg_monthly_spend"]
REPORT_PRODUCTS = ["product_key", "product_name", "category", "subcategory", "cost", "last_sale_date", "recency",
                   "product_tier", "lifespan", "total_orders", "total_sales", "total_quantity", "total_customers",
                   "avg_selling_price", "avg_order_revenue", "avg_monthly_spend"]


def _average_per_order(total, orders, exact_average: bool):
    # Bigint / bigint truncates in the source before ROUND(.., 2).
    ratio = exact_ratio(total, orders) if exact_average else int_div(total, orders)
    return round2(F.when(F.col(orders) == 0, F.lit(0)).otherwise(ratio))


def _average_per_month(total, lifespan):
    return round2(F.when(F.col(lifespan) == 0, F.col(total).cast(EXACT)).otherwise(exact_ratio(total, lifespan)))


def customer_report(gold: dict[str, DataFrame], as_of=None, exact_average: bool = False) -> DataFrame:
    now = as_of_col(as_of)
    f = gold["fact_sales"].where(F.col("order_date").isNotNull())
    per_key = A.two_distinct_counts(f, "customer_key", "order_number", "product_key", {
        "total_sales": (F.sum, F.col("sales_amount").cast("bigint")), "total_quantity": (F.sum, F.col("quantity").cast("bigint")),
        "last_order_date": (F.max, F.col("order_date")), "_first": (F.min, F.col("order_date"))}) \
        .withColumnsRenamed({"n_first": "total_orders", "n_second": "total_products"})
    c = gold["dim_customers"].select(
        "customer_key", "customer_number",
        full_name("first_name", "last_name").alias("customer_name"),
        age_years(now, F.col("birthdate")).alias("age"))
    j = per_key.join(c, "customer_key", "left") \
        .withColumn("customer_name", F.coalesce("customer_name", full_name(F.lit(None), F.lit(None))))
    j = j.withColumn("lifespan", whole_months(F.col("last_order_date"), F.col("_first")))
    out = j.select(
        "customer_key", "customer_number", "customer_name", "age",
        A.age_bracket(F.col("age")).alias("age_bracket"),
        A.customer_tier(F.col("lifespan"), F.col("total_sales")).alias("customer_tier"),
        "last_order_date",
        whole_months(now, F.col("last_order_date")).alias("recency"),
        "total_orders", "total_sales", "total_quantity", "total_products", "lifespan",
        _average_per_order("total_sales", "total_orders", exact_average).alias("avg_order_value"),
        _average_per_month("total_sales", "lifespan").alias("avg_monthly_spend"),
    )
    return out.select(*REPORT_CUSTOMERS)


def _ratio_digits(num: Column, den: Column) -> list[Column]:
    """``num / den`` cut to 18 digits: whole part, then the next six digits three times; NULL where ``den`` is 0 or NULL."""
    out = []
    for _ in range(4):
        out.append(F.when(den != 0, int_div(num, den)))
        num = F.when(den != 0, num % den) * 1_000_000
    return out


def product_report(gold: dict[str, DataFrame], as_of=None, exact_average: bool = False) -> DataFrame:
    now = as_of_col(as_of)
    f = gold["fact_sales"].where(F.col("order_date").isNotNull())
    # AVG(sales / NULLIF(quantity, 0)): each ratio as its whole part and three groups of six digits, all of them long.
    digits = _ratio_digits(F.col("sales_amount").cast("bigint"), F.col("quantity").cast("bigint"))
    per_key = A.two_distinct_counts(f, "product_key", "order_number", "customer_key", {
        "last_sale_date": (F.max, F.col("order_date")), "_first": (F.min, F.col("order_date")),
        "total_sales": (F.sum, F.col("sales_amount").cast("bigint")), "total_quantity": (F.sum, F.col("quantity").cast("bigint")),
        **{f"_price{i}": (F.sum, d) for i, d in enumerate(digits)}, "_priced": (F.sum, digits[0].isNotNull().cast("bigint"))}) \
        .withColumnsRenamed({"n_first": "total_orders", "n_second": "total_customers"})
    prices = sum((F.col(f"_price{i}").cast(EXACT) * F.lit(Decimal(1).scaleb(-6 * i)) for i in range(1, 4)),
                 F.col("_price0").cast(EXACT))
    per_key = per_key.withColumn("avg_selling_price", round2(F.when(
        F.col("_priced") > 0, prices.cast("decimal(38,18)") / F.col("_priced").cast(EXACT))))
    p = gold["dim_products"].select("product_key", "product_name", "category", "subcategory", "cost")
    # The source groups on the dimension's key: unmatched fact keys form one NULL group.
    j = per_key.join(p.withColumnRenamed("product_key", "_pk"), F.col("product_key") == F.col("_pk"), "left") \
        .drop("product_key").withColumnRenamed("_pk", "product_key")
    j = j.withColumn("lifespan", whole_months(F.col("last_sale_date"), F.col("_first")))
    out = j.select(
        "product_key", "product_name", "category", "subcategory", "cost", "last_sale_date",
        whole_months(now, F.col("last_sale_date")).alias("recency"),
        A.product_tier(F.col("total_sales")).alias("product_tier"),
        "lifespan", "total_orders", "total_sales", "total_quantity", "total_customers", "avg_selling_price",
        _average_per_order("total_sales", "total_orders", exact_average).alias("avg_order_revenue"),
        _average_per_month("total_sales", "lifespan").alias("avg_monthly_spend"),
    )
    return out.select(*REPORT_PRODUCTS)
