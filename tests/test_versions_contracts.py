"""Versions of a refresh, declared types and widths, and the live report views."""
import os

import pytest
from pyspark.sql import functions as F

from tierwise.plans import reports as R
from tierwise.plans import warehouse as W
from tierwise.plans.report_views import set_report_date
from tierwise.sources import versions
from tierwise.sources.bronze import conform, too_wide, within_widths
from tierwise.sources.schemas import GOLD, SILVER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bronze(spark):
    from tierwise.sources.testdata import bronze_from_testdata
    return bronze_from_testdata(spark, SF)


def _half(bronze):
    return {**bronze, "crm_sales_details": bronze["crm_sales_details"].where("sls_quantity % 2 = 0")}


def _rows(df):
    return sorted(map(str, df.drop("dwh_create_date").collect()))


def test_readers_see_whole_versions(spark, bronze, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    assert versions.current(spark, root) is None
    first = W.refresh(spark, bronze, root, "2002-01-01")
    facts = _rows(first.gold["fact_sales"])

    # A refresh that dies half way, after all layers but the fact are written.
    def dies(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(W.G, "fact_sales", dies)
        with pytest.raises(RuntimeError):
            W.refresh(spark, _half(bronze), root, "2002-01-01")
    assert len(os.listdir(os.path.join(root, "versions"))) == 2
    assert _rows(W.open_refresh(spark, root).gold["fact_sales"]) == facts

    second = W.refresh(spark, _half(bronze), root, "2002-01-01")
    reopened = W.open_refresh(spark, root)
    assert reopened.root == second.root and reopened.home == root
    assert len(_rows(reopened.gold["fact_sales"])) < len(facts)
    assert _rows(first.gold["fact_sales"]) == facts                     # a reader that is still at the old version
    third = W.refresh(spark, bronze, root, "2002-01-01")
    kept = [os.path.basename(w.root) for w in (second, third)]
    assert versions.committed(spark, root) == kept and sorted(os.listdir(os.path.join(root, "versions"))) == kept

    # Live views: they follow what is published, and the date that is set.
    for wh in (second, third):
        wh.publish("2002-01-01")
        for name, report in (("report_customers", R.customer_report), ("report_products", R.product_report)):
            for day in ("2002-01-01", "2010-07-15"):
                set_report_date(spark, day)
                got, want = spark.sql(f"SELECT * FROM gold.{name}"), report(wh.gold, day)
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert not [x for x in plan.split("\n") if "Expand [" in x]
                assert sum("FileScan" in x and "sales_amount" in x for x in plan.split("\n")) == 1
                assert got.dtypes == want.dtypes and _rows(got) == _rows(want)


def test_tables_are_stored_by_store_assignment(spark):
    contract = GOLD["fact_sales"]
    row = spark.range(1).select(*[F.lit(None).cast("date" if f.name.endswith("date") else "int" if f.name != "order_number" else "string")
                                  .alias(f.name) for f in contract.fields])
    out = conform(row.select(*reversed(row.columns)), contract)
    assert out.columns == contract.names and dict(out.dtypes)["product_key"] == "bigint" and dict(out.dtypes)["order_number"] == "string"
    with pytest.raises(Exception):                      # text is never taken for a number
        conform(row.withColumn("quantity", F.lit("3")), contract)
    with pytest.raises(Exception):                      # nor a value that overflows
        conform(row.withColumn("quantity", F.lit(1 << 40)), contract).collect()
    with pytest.raises(Exception):                      # nor a missing column for NULL
        conform(row.drop("price"), contract).collect()
    assert all(s.names[-1] == "dwh_create_date" for s in SILVER.values())


def test_widths(spark):
    df = spark.createDataFrame([("a" * 50, None, 1), ("b" * 51, "x", 2), ("c", "y" * 60, 3), (None, None, 4)], "s string, t string, n int")
    widths = {"s": 50, "t": 50}
    assert [r.n for r in df.where(too_wide(widths)).collect()] == [2, 3]
    kept, rejected = within_widths(df, widths, "reject")
    assert [r.n for r in kept.collect()] == [1, 4] and [(r.n, r.too_wide) for r in rejected.collect()] == [(2, "s"), (3, "t")]
    assert within_widths(df, widths, "keep")[0].count() == 4
    with pytest.raises(Exception, match="value too long"):
        within_widths(df, widths, "fail")[0].collect()
    assert within_widths(df.where("n in (1, 4)"), widths, "fail")[0].count() == 2
    with pytest.raises(ValueError):
        within_widths(df, widths, "drop")


def test_rejected_rows_are_written(spark, bronze, tmp_path):
    wh = W.refresh(spark, bronze, str(tmp_path / "wh"), "2002-01-01", too_wide="reject")
    rejected = spark.read.parquet(os.path.join(wh.root, "rejects", "crm_cust_info"))
    n = bronze["crm_cust_info"].count()
    assert rejected.count() > 0 and wh.bronze["crm_cust_info"].count() + rejected.count() == n
    assert {r.too_wide for r in rejected.select("too_wide").distinct().collect()} == {"cst_firstname"}
