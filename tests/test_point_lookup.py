"""Point lookups by key (P10): few row groups are read, whatever the order of the rows."""
import pytest
from pyspark.sql import functions as F

from tierwise.operators.quality import first_duplicated_key, versions_of_key
from tierwise.sources.bronze import lookup_options, read_layer, write_layer


def _rows_scanned(df):
    """Rows that the scan handed on, by its own count; they come from the row groups that weren't skipped."""
    plan = df.select("*")._jdf.queryExecution().executedPlan()      # a plan of its own, whose counts start at zero
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("dictionary", ["true", "false"])
def test_lookup_reads_few_row_groups(spark, tmp_path, dictionary):
    rows = spark.range(0, 40_000, 1, 20).select((F.xxhash64("id") % 10**9).alias("k"), "id")     # every file spans all keys
    one = rows.where("id = 12345").first()["k"]
    for name, options in (("with", lookup_options(["k"])), ("without", {})):
        rows.write.options(**options).option("parquet.enable.dictionary", dictionary).parquet(str(tmp_path / name))
    found = {n: spark.read.parquet(str(tmp_path / n)).where(F.col("k") == F.lit(one)) for n in ("with", "without")}
    assert [r["id"] for r in found["with"].collect()] == [r["id"] for r in found["without"].collect()] == [12345]
    assert _rows_scanned(found["with"]) <= 4_000
    if dictionary == "false":
        assert _rows_scanned(found["without"]) == 40_000            # statistics alone skip nothing here


def test_versions_of_a_key(spark, tmp_path):
    rows = spark.createDataFrame([(7, "2024-01-01"), (7, None), (7, "2025-01-01"), (9, "2024-01-01"), (9, "2024-01-01"),
                                  (None, "2024-01-01"), (None, "2024-01-01"), (1, "2024-01-01")], "cst_id int, d string")
    write_layer(rows, str(tmp_path), "bronze", "crm_cust_info")
    rows = read_layer(spark, str(tmp_path), "bronze", "crm_cust_info")
    assert first_duplicated_key(rows, "cst_id") == 7
    got = versions_of_key(rows, "cst_id", 7, "d").orderBy("latest_update").collect()
    assert [(r.d, r.latest_update) for r in got] == [(None, 1), ("2025-01-01", 2), ("2024-01-01", 3)]
    assert versions_of_key(rows, "cst_id", None, "d").count() == 0
    assert first_duplicated_key(rows.where("cst_id = 1"), "cst_id") is None
