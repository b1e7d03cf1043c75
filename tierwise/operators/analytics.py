"""User-level analytic operators over the star schema.

Every window here runs *after* an aggregation, on one row per period /
group, except :func:`top_k`, whose rank filter Catalyst plans as a partial
``WindowGroupLimit`` before the exchange. Windows without a partition key
therefore only ever see a bounded number of rows (periods, categories, tiers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import (
    EXACT, band, change_label, exact_ratio, pct_text, period_start, round2, whole_months,  # noqa: F401
)

# Segmentation thresholds and labels of the analytic queries.
COST_BANDS = [("<", 100, "Below 100"), ("between", (100, 500), "100-500"),
              ("between", (501, 1000), "501-1000")]
COST_DEFAULT = "Above 1000"
AGE_BANDS = [("<", 20, "Under 20"), ("between", (20, 29), "20-29"), ("between", (30, 39), "30-39"),
             ("between", (40, 49), "40-49")]
AGE_DEFAULT = "50 and Above"
VIP, REGULAR, NEW = "VIP Customer", "Regular Customer", "New Customer"
TIER_MIN_MONTHS, VIP_MIN_SPEND = 12, 5000
HIGH, MID, LOW = "High Performer", "Mid Performer", "Low Performer"
HIGH_ABOVE, MID_FROM = 50000, 10000
ABOVE_AVG, BELOW_AVG, AT_AVG = "Above Avg", "Below Avg", "Avg"


def _rules(c: Column, spec) -> list[tuple[Column, str]]:
    out = []
    for op, bound, label in spec:
        out.append((c < bound if op == "<" else c.between(*bound), label))
    return out


def cost_range(c: Column) -> Column:
    """Product cost band."""
    return band(_rules(c, COST_BANDS), COST_DEFAULT)


def age_bracket(c: Column) -> Column:
    """Customer age bracket (R5); NULL age falls in the last bracket."""
    return band(_rules(c, AGE_BANDS), AGE_DEFAULT)


def customer_tier(lifespan: Column, spend: Column) -> Column:
    """VIP / Regular / New by lifespan in months and total spend."""
    return band([((lifespan >= TIER_MIN_MONTHS) & (spend >= VIP_MIN_SPEND), VIP),
                 ((lifespan >= TIER_MIN_MONTHS) & (spend < VIP_MIN_SPEND), REGULAR)], NEW)


def product_tier(sales: Column) -> Column:
    """High / Mid / Low performer by total revenue."""
    return band([(sales > HIGH_ABOVE, HIGH), (sales >= MID_FROM, MID)], LOW)


def period_rollup(df: DataFrame, date: str, grain: str, measures: dict[str, Column],
                  out: str = "order_date", where_not_null: bool = True) -> DataFrame:
    """Group facts by calendar period (R1). ``measures`` maps alias -> aggregate."""
    if where_not_null:
        df = df.where(F.col(date).isNotNull())
    return df.groupBy(period_start(date, grain).alias(out)).agg(*[m.alias(a) for a, m in measures.items()])


def period_change(df: DataFrame, order: str, value: str, partition: Sequence[str] = (),
                  prev: str = "prev_sales", diff: str = "difference_sales",
                  label: str = "prev_change") -> DataFrame:
    """Previous value, difference and direction label (R2). ``prev`` computed once."""
    w = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_last())
    out = df.withColumn(prev, F.lag(value).over(w))
    out = out.withColumn(diff, F.col(value) - F.col(prev))
    return out.withColumn(label, change_label(diff))


def running_total(df: DataFrame, order: str, value: str, reset_by: Column | None = None,
                  out: str = "running_total") -> DataFrame:
    """Cumulative sum in ``order`` (RANGE frame, ties summed together), optional reset."""
    w = Window.orderBy(F.col(order).asc_nulls_last())
    if reset_by is not None:
        w = Window.partitionBy(reset_by).orderBy(F.col(order).asc_nulls_last())
    w = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def rolling_avg(df: DataFrame, order: str, value: str, n: int, out: str) -> DataFrame:
    """Average of the current and ``n - 1`` preceding *rows*, rounded to cents."""
    w = Window.orderBy(F.col(order).asc_nulls_last()).rowsBetween(-(n - 1), Window.currentRow)
    s = F.sum(F.col(value).cast(EXACT)).over(w)
    c = F.count(F.col(value)).over(w)
    return df.withColumn(out, round2(exact_ratio(s, c)))


def top_k(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """First ``k`` rows per partition by ``order`` (R7). ``order`` should end in a
    unique tie-break so the ranking is deterministic."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def vs_average(df: DataFrame, partition: Sequence[str], value: str, avg: str = "avg_sales",
               diff: str = "difference_avg", label: str = "avg_change") -> DataFrame:
    """Group average, difference to it and Above/Below/Avg label (R8), exact decimals."""
    w = Window.partitionBy(*partition)
    s = F.sum(F.col(value).cast(EXACT)).over(w)
    c = F.count(F.col(value)).over(w)
    mean = exact_ratio(s, c)
    d = F.col(value).cast(EXACT) - mean
    return (df.withColumn(avg, round2(mean))
            .withColumn(diff, round2(d))
            .withColumn(label, change_label(d, ABOVE_AVG, BELOW_AVG, AT_AVG)))


def profit_margin(df: DataFrame, keys: Sequence[str], revenue: str = "sales_amount",
                  qty: str = "quantity", price: str = "price", cost: str = "cost", profit: str | None = None) -> DataFrame:
    """Revenue, quantity, max price/cost, profit and margin text per group (R9); of rows that are
    already aggregated, ``profit`` names the column that holds theirs."""
    profit = F.sum(F.col(profit) if profit else F.col(qty) * (F.col(price) - F.col(cost)))
    agg = df.groupBy(*keys).agg(
        F.sum(revenue).alias("total_revenue"),
        F.sum(qty).alias("total_quantity"),
        F.max(price).alias("price"),
        F.max(cost).alias("cost"),
        profit.alias("profit"),
    )
    return agg.withColumn("profit_margin", pct_text("profit", "total_revenue"))


def share_of_total(df: DataFrame, key: str | Sequence[str], value: str, total: str = "overall_amount",
                   pct: str = "percentage_of_total") -> DataFrame:
    """Grand total over all groups and each group's share as text.

    Expects one row per group (aggregate first). The total is ``SUM(value)
    OVER ()`` over those group rows: one small single-partition window on the
    aggregated result. A scalar subquery instead would re-run the whole
    aggregation (a second pass over the fact) to save a window over a few rows.
    """
    w = Window.partitionBy()
    return (df.withColumn(total, F.sum(value).over(w))
            .withColumn(pct, pct_text(F.col(value), F.col(total))))


def lifespan_months(first: Column, last: Column) -> Column:
    """Months between first and last order."""
    return whole_months(last, first)


# Rows that one task sorts or groups in :func:`two_distinct_counts`, however many there are and whatever the session's number
# of shuffle partitions is; parts over which the rows of one key are dealt.
ROWS_A_TASK = 500_000
KEY_PARTS = 1024


def _tasks(df: DataFrame) -> int:
    """Partitions for all rows of ``df``: the session's number, more where a task would get over :data:`ROWS_A_TASK` rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def two_distinct_counts(df: DataFrame, key: str, first: str, second: str, measures: dict) -> DataFrame:
    """Per ``key``: ``n_first`` and ``n_second``, the exact distinct counts of two columns, and ``measures`` (name ->
    (aggregate that also merges its own results, such as sum, min or max, and column)).

    Rows are dealt by (key, part of ``first``), where one row of each (key, first) is marked and rows of a (key, second) become
    one; then by (key, part of ``second``), where rows of a (key, second) and then of the part become one; then by key, with marks
    and measures carried along. So no stage shuffles more rows than it got, a single key's rows are spread over up to
    :data:`KEY_PARTS` tasks, and the number of tasks follows the number of rows, so that none needs more memory as they grow.
    NULLs aren't counted; a NULL key is a group.
    """
    def merged(frame: DataFrame, *by: str, **more: Column) -> DataFrame:
        return frame.groupBy(*by).agg(*[m.alias(name) for name, m in more.items()],
                                      *[fn(F.col(name)).alias(name) for name, (fn, _) in measures.items()])

    def part(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(KEY_PARTS)).cast("int")

    n = _tasks(df)
    rows = df.select(key, first, second, *[c.alias(name) for name, (_, c) in measures.items()], part(first).alias("_part"))
    # The hash comes first, so that the sort rarely has to compare what it stands for.
    one = Window.partitionBy(F.xxhash64(key, first), key, "_part", first).orderBy(F.lit(0))
    mark = ((F.row_number().over(one) == 1) & F.col(first).isNotNull()).cast("bigint")
    marked = rows.repartition(n, key, "_part").withColumn("n_first", mark)
    pairs = merged(marked, key, "_part", second, n_first=F.sum("n_first")).withColumn("_part", part(second))
    pairs = merged(pairs.repartition(n, key, "_part"), key, "_part", second, n_first=F.sum("n_first"))
    parts = merged(pairs, key, "_part", n_first=F.sum("n_first"), n_second=F.count(second))
    return merged(parts.repartition(n, key), key, n_first=F.sum("n_first"), n_second=F.sum("n_second"))
