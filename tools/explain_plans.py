"""Write PLANS.md: final physical plans of the key operators.

Each plan is shown twice: as planned for the small test data, and with
broadcast joins disabled, which is how the same query plans when dimensions
are too large to broadcast (the 100 TB case).

    python tools/explain_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tierwise.operators.keys import with_surrogate_key  # noqa: E402
from tierwise.operators.quality import orphans_not_in  # noqa: E402
from tierwise.plans import checks as C  # noqa: E402
from tierwise.plans import gold as G  # noqa: E402
from tierwise.plans import queries as Q  # noqa: E402
from tierwise.plans import reports as R  # noqa: E402
from tierwise.plans import silver as S  # noqa: E402
from tierwise.plans.warehouse import warehouse_for  # noqa: E402
from tierwise.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    txt = df._jdf.queryExecution().executedPlan().toString()
    txt = txt.split("+- == Initial Plan ==")[0]
    txt = re.sub(r"#\d+L?", "", txt)
    txt = re.sub(r", \[plan_id=\d+\]", "", txt)
    txt = re.sub(r"file:[^\],]*", "<path>", txt)
    return "\n".join(line[:160] for line in txt.split("\n") if line.strip())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = build_session("local[8]", 8, "explain")
    wh = warehouse_for(spark, sf)
    s = {k: v.drop("dwh_create_date") for k, v in wh.silver.items()}
    cases = [
        ("E1 latest row per key (silver customers)",
         "a partial WindowGroupLimit below the exchange on cst_id: one row per key leaves each map task",
         lambda: S.silver_customers(wh.bronze["crm_cust_info"])),
        ("G6 fact key lookup",
         "one scan of silver sales, two left joins on (salt, key); NULL keys are spread over salts",
         lambda: G.fact_sales(s, wh.gold)),
        ("G1 distributed surrogate key",
         "rows read from their sorted ranges; offsets from one row per range",
         lambda: with_surrogate_key(
             s["crm_cust_info"].select("cst_id", "cst_key"), [F.col("cst_id").asc_nulls_last()], "customer_key")),
        ("Q8 rolling 3-month average",
         "the row-frame window runs after the monthly aggregation (one row per month)",
         lambda: Q.q08_rolling_3_month_avg(wh.gold)),
        ("Q11 top 5 customers per year",
         "pre-aggregation per (year, customer) before the join; a partial WindowGroupLimit before the exchange",
         lambda: Q.q11_top5_customers_by_sales(wh.gold)),
        ("Q15 profit margins",
         "aggregation per product before the join to the product dimension",
         lambda: Q.q15_profit_margins(wh.gold)),
        ("Q20 customer report",
         "one fact scan, grouped in stages for the two exact distinct counts (no Expand), then a customer-sized join",
         lambda: R.customer_report(wh.gold, "2002-01-01")),
        ("K8 NOT IN orphans",
         "a plain LeftAnti join (no nested loop) plus two one-row EXISTS subqueries",
         lambda: orphans_not_in(wh.bronze["crm_sales_details"], "sls_cust_id",
                                wh.silver["crm_cust_info"], "cst_id")),
        ("DQ suite",
         "filter-only checks fused into one aggregation per source table",
         lambda: C.suite(wh)),
    ]
    parts = ["# Physical plans\n",
             "Generated by `tools/explain_plans.py` on `" + sf + "` (final adaptive plans, expression ids "
             "and paths removed). *Small* = as planned for the test data; *No broadcast* = "
             "`spark.sql.autoBroadcastJoinThreshold=-1`, the shape at 100 TB where dimensions are too large "
             "to broadcast.\n"]
    for title, note, build in cases:
        small = final_plan(build())
        parts.append(f"\n## {title}\n\nLook for: {note}.\n\n### Small\n\n```\n{small}\n```\n")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            large = final_plan(build())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        strip = lambda t: re.sub(r"(ResultQueryStage|ShuffleQueryStage|BroadcastQueryStage|TableCacheQueryStage) \d+|\*\(\d+\) ", "", t)
        if strip(large) == strip(small):
            parts.append("\n### No broadcast\n\nSame plan.\n")
        else:
            parts.append(f"\n### No broadcast\n\n```\n{large}\n```\n")
    with open(out, "w") as fh:
        fh.write("".join(parts))
    print(out)


if __name__ == "__main__":
    main()
