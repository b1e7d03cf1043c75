"""The two reports as SQL views over the published gold tables.

``gold.report_customers`` and ``gold.report_products`` hold expressions only: they follow the tables that ``gold.*`` shows, and the date
that the function ``gold.report_date()`` gives (today, unless another one is set). Thresholds and labels are those of
:mod:`tierwise.operators.analytics`, from whose operators :mod:`.reports` builds the same reports as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import analytics as A

_MONTHS = """CREATE OR REPLACE FUNCTION gold.whole_months(a DATE, b DATE) RETURNS INT RETURN
  CASE WHEN a >= b THEN 1 WHEN a < b THEN -1 END
  * ((year(greatest(a, b)) - year(least(a, b))) * 12 + month(greatest(a, b)) - month(least(a, b))
     - IF(day(greatest(a, b)) < day(least(a, b)), 1, 0))"""


def _bands(column: str, bands: list, default: str) -> str:
    def test(op, bound):
        return f"{column} < {bound}" if op == "<" else f"{column} BETWEEN {bound[0]} AND {bound[1]}"
    return "CASE " + " ".join(f"WHEN {test(op, bound)} THEN '{label}'" for op, bound, label in bands) + f" ELSE '{default}' END"


def _totals(key: str, other: str, more: dict[str, str]) -> str:
    """Per ``key``: distinct orders and distinct values of ``other``, sums, and ``more`` sums, by grouping in stages (no Expand)."""
    sums = {"sales": "CAST(sales_amount AS BIGINT)", "items": "CAST(quantity AS BIGINT)", **more}

    def carried(names: str = "{0}") -> str:
        return ", ".join(f"SUM({names.format(c, e)}) AS {c}" for c, e in sums.items())
    return f"""lines AS (
    SELECT {key}, order_number, {other}, {carried('{1}')}, MIN(order_date) AS first_date, MAX(order_date) AS last_date
    FROM gold.fact_sales WHERE order_date IS NOT NULL GROUP BY {key}, order_number, {other}),
  marked AS (
    SELECT *, IF(order_number IS NULL OR row_number() OVER (PARTITION BY {key}, order_number ORDER BY {other}) > 1, 0, 1) AS orders
    FROM lines),
  pairs AS (
    SELECT {key}, {other}, SUM(orders) AS orders, {carried()}, MIN(first_date) AS first_date, MAX(last_date) AS last_date
    FROM marked GROUP BY {key}, {other}),
  totals AS (
    SELECT {key} AS totals_key, SUM(orders) AS orders, COUNT({other}) AS others, {carried()}, MIN(first_date) AS first_date,
           MAX(last_date) AS last_date, gold.whole_months(MAX(last_date), MIN(first_date)) AS lifespan
    FROM pairs GROUP BY {key})"""


_PER_ORDER = "CAST(IF(orders = 0, 0, sales DIV orders) AS DECIMAL(18, 2))"
_PER_MONTH = "CAST(round(IF(lifespan = 0, CAST(sales AS DECIMAL(38, 18)), CAST(sales AS DECIMAL(20, 0)) " \
             "/ CAST(nullif(lifespan, 0) AS DECIMAL(20, 0))), 2) AS DECIMAL(18, 2))"

CUSTOMERS = f"""CREATE OR REPLACE VIEW gold.report_customers AS
  WITH {_totals('customer_key', 'product_key', {})},
  aged AS (SELECT *, CAST(gold.whole_months(gold.report_date(), birthdate) DIV 12 AS INT) AS age FROM gold.dim_customers)
  SELECT totals_key AS customer_key, customer_number, concat_ws(' ', coalesce(first_name, ''), coalesce(last_name, '')) AS customer_name, age,
         {_bands('age', A.AGE_BANDS, A.AGE_DEFAULT)} AS age_bracket,
         CASE WHEN lifespan >= {A.TIER_MIN_MONTHS} AND sales >= {A.VIP_MIN_SPEND} THEN '{A.VIP}'
              WHEN lifespan >= {A.TIER_MIN_MONTHS} AND sales < {A.VIP_MIN_SPEND} THEN '{A.REGULAR}' ELSE '{A.NEW}' END AS customer_tier,
         last_date AS last_order_date, gold.whole_months(gold.report_date(), last_date) AS recency, orders AS total_orders,
         sales AS total_sales, items AS total_quantity, others AS total_products, lifespan, {_PER_ORDER} AS avg_order_value,
         {_PER_MONTH} AS avg_monthly_spend
  FROM totals LEFT JOIN aged ON customer_key = totals_key"""

_RATIO = "CASE WHEN quantity <> 0 THEN CAST(sales_amount AS DECIMAL(20, 0)) / CAST(quantity AS DECIMAL(20, 0)) END"

PRODUCTS = f"""CREATE OR REPLACE VIEW gold.report_products AS
  WITH {_totals('product_key', 'customer_key', {'prices': _RATIO, 'priced': f'IF(({_RATIO}) IS NULL, 0L, 1L)'})}
  SELECT product_key, product_name, category, subcategory, cost, last_date AS last_sale_date,
         gold.whole_months(gold.report_date(), last_date) AS recency,
         CASE WHEN sales > {A.HIGH_ABOVE} THEN '{A.HIGH}' WHEN sales >= {A.MID_FROM} THEN '{A.MID}' ELSE '{A.LOW}' END AS product_tier,
         lifespan, orders AS total_orders, sales AS total_sales, items AS total_quantity, others AS total_customers,
         CAST(round(prices / CAST(nullif(priced, 0) AS DECIMAL(20, 0)), 2) AS DECIMAL(18, 2)) AS avg_selling_price,
         {_PER_ORDER} AS avg_order_revenue, {_PER_MONTH} AS avg_monthly_spend
  FROM totals LEFT JOIN gold.dim_products ON product_key = totals_key"""


def set_report_date(spark: SparkSession, as_of=None) -> None:
    """The date of both views from now on; None: the day on which they are read."""
    value = f"DATE '{as_of}'" if as_of else "current_date()"
    spark.sql(f"CREATE OR REPLACE FUNCTION gold.report_date() RETURNS DATE RETURN {value}")


def create_report_views(spark: SparkSession, as_of=None) -> list[str]:
    spark.sql(_MONTHS)
    set_report_date(spark, as_of)
    spark.sql(CUSTOMERS)
    spark.sql(PRODUCTS)
    return ["gold.report_customers", "gold.report_products"]
