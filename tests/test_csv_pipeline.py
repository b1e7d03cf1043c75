"""End-to-end from CSV extracts written here."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.plans.checks import suite
from tierwise.plans.warehouse import refresh_from_csv

PRD = """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
1,AC-HE-HL-U509-R,Helmet red,12,S ,2011-07-01,2007-12-28
2,AC-HE-HL-U509-R,Helmet red,14,S ,2012-07-01,
3,CO-RF-FR-R92B-58,Frame black,,R ,2003-07-01,
4,CO-RF-FR-R92R-58,Frame red,,R ,2003-07-01,
5,CO-PE-PD-M282,Pedal,3,,2013-07-01,
"""
CAT = """ID,CAT,SUBCAT,MAINTENANCE
AC_HE,Accessories,Helmets,Yes
CO_RF,Components,Road Frames,Yes
"""
CUST = """cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date
1,A1, Ann ,Lee,S,F,2025-01-01
1,A1,Ann, Lee , m ,f,2025-02-01
2,A2,Bo,,,,2025-01-01
2,A2,Bob,,X,,
,A3,No,Key,S,M,2025-01-01
"""
SALES = """sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price
SO1,HL-U509-R,1,20101229,20110105,20110110,20,2,10
SO2,HL-U509-R,2,0,20110105,20110110,,2,10
SO3,FR-R92B-58,1,20121229,20130105,20130110,21,2,-10
SO4,NOPE,9,20101229,20110105,20110110,5,1,5
"""
AZ12 = """cid,bdate,gen
NASA1,1971-10-06,M
A2,2999-01-01,Female
"""
LOC = """cid,cntry
A-1, DE
A-2,
"""


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    for name, text in (("cust_info.csv", CUST), ("sales_details.csv", SALES), ("cust_az12.csv", AZ12),
                       ("loc_a101.csv", LOC), ("prd_info.csv", PRD), ("categories.csv", CAT)):
        (d / name).write_text(text.replace("\n", "\r\n"))
    files = {"crm_cust_info": "cust_info.csv", "crm_prd_info": "prd_info.csv", "crm_sales_details": "sales_details.csv",
             "erp_loc_a101": "loc_a101.csv", "erp_cust_az12": "cust_az12.csv", "erp_px_cat_g1v2": "categories.csv"}
    return refresh_from_csv(spark, str(d), str(tmp_path_factory.mktemp("out")), "2025-06-01", files=files)


def test_gold_from_csv(wh):
    cust = {r.customer_id: r for r in wh.gold["dim_customers"].collect()}
    assert set(cust) == {1, 2}
    a = cust[1]
    assert (a.customer_key, a.first_name, a.last_name, a.gender, a.marital_status, a.country, a.birthdate) == \
        (1, "Ann", "Lee", "Female", "Married", "Germany", dt.date(1971, 10, 6))
    b = cust[2]
    assert (b.gender, b.birthdate, b.country, b.create_date) == ("Unknown", None, "Unkown", None)
    assert wh.gold["dim_products"].count() == 4
    fact = {r.order_number: r for r in wh.gold["fact_sales"].collect()}
    assert fact["SO1"].product_key is not None and fact["SO1"].customer_key == 1
    assert fact["SO2"].order_date is None and fact["SO2"].sales_amount == 20
    assert (fact["SO3"].sales_amount, fact["SO3"].price) == (20, 10)
    assert fact["SO4"].product_key is None and fact["SO4"].customer_key is None


def test_quality_suite_flags_orphans(wh):
    got = {r.check: r.violations for r in wh.quality.collect()}
    assert got == {r.check: r.violations for r in suite(wh).collect()}
    assert got["k09_orphan_fact_customers"] == 1 and got["k09_orphan_fact_products"] == 1
    assert got["k08_orphan_sales_products"] == 1
    assert got["k01_duplicate_customer_ids"] == 2
    assert got["k05_cost_null_or_negative"] == 2
    assert got["k13_future_birthdates"] == 1


def test_quoted_empty_is_empty_string(spark, tmp_path):
    from tierwise.sources.bronze import read_bronze
    p = tmp_path / "loc.csv"
    p.write_text('cid,cntry\r\nAW-1,""\r\nAW-2,\r\n"",DE\r\n')
    got = [tuple(r) for r in read_bronze(spark, str(p), "erp_loc_a101").collect()]
    assert got == [("AW-1", ""), ("AW-2", None), ("", "DE")]


def test_quoting_as_copy_reads_it(spark, tmp_path):
    from tierwise.sources.bronze import read_bronze, write_extract
    p = tmp_path / "cat.csv"
    p.write_text('id,cat,subcat,maintenance\n"A""B","C:\\","two\nlines",x\\y\n"p,q",,"",No\n')
    want = [('A"B', "C:\\", "two\nlines", "x\\y"), ("p,q", None, "", "No")]
    df = read_bronze(spark, str(p), "erp_px_cat_g1v2")
    assert [tuple(r) for r in df.collect()] == want
    write_extract(df, str(tmp_path / "again"))
    again = read_bronze(spark, str(tmp_path / "again"), "erp_px_cat_g1v2")
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


def test_extra_column_fails_the_load(spark, tmp_path):
    from tierwise.sources.bronze import read_bronze
    p = tmp_path / "cat.csv"
    p.write_text("id,cat,subcat,maintenance\nA,B,C,D,E\n")
    with pytest.raises(Exception):
        read_bronze(spark, str(p), "erp_px_cat_g1v2").collect()


def test_reload_replaces_the_whole_table(spark, tmp_path):
    from tierwise.sources.bronze import write_layer
    write_layer(spark.range(10), str(tmp_path), "bronze", "t")
    write_layer(spark.range(3), str(tmp_path), "bronze", "t")
    assert spark.read.parquet(str(tmp_path / "bronze" / "t")).count() == 3


def test_report_views_equal_the_reports(spark, wh):
    from tierwise.plans import reports as R
    assert {"gold.report_customers", "gold.report_products"} <= set(wh.publish("2025-06-01"))
    for name, fn in (("report_customers", R.customer_report), ("report_products", R.product_report)):
        a, b = spark.sql(f"SELECT * FROM gold.{name}"), fn(wh.gold, "2025-06-01")
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_malformed_row_fails_the_load(spark, tmp_path):
    from tierwise.sources.bronze import read_bronze
    p = tmp_path / "cat.csv"
    p.write_text("id,cat,subcat,maintenance\r\nA,B,C,D\r\nonly,three,fields\r\n")
    with pytest.raises(Exception):
        read_bronze(spark, str(p), "erp_px_cat_g1v2").collect()


def test_command_line_refresh(spark, tmp_path, capsys):
    import json

    from tierwise.__main__ import main
    crm, erp = tmp_path / "source_crm", tmp_path / "source_erp"
    crm.mkdir()
    erp.mkdir()
    (crm / "cust_info.csv").write_text(CUST)
    (crm / "sales_details.csv").write_text(SALES)
    (crm / "prd_info.csv").write_text(
        "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
        "212,AC-HE-HL-U509-R,Sport-100 Helmet- Red,12,S ,2011-07-01,2007-12-28\n"
        "213,AC-HE-HL-U509-R,Sport-100 Helmet- Red,14,S ,2012-07-01,\n")
    (erp / "CUST_AZ12.csv").write_text(AZ12)
    (erp / "LOC_A101.csv").write_text(LOC)
    (erp / "PX_CAT_G1V2.csv").write_text("ID,CAT,SUBCAT,MAINTENANCE\nAC_HE,Accessories,Helmets,No\n")
    assert main(["refresh", "--landing", str(tmp_path), "--out", str(tmp_path / "out"), "--as-of", "2025-06-01"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert "gold.fact_sales" in lines[0]["published"] and "quality.dq_suite" in lines[0]["published"]
    checks = {x["check"]: x["violations"] for x in lines[1:]}
    assert checks["k09_orphan_fact_products"] == 2   # SO3 and SO4 reference no current product


def test_refresh_into_a_fixed_root_is_idempotent(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("landing2")
    for name, text in (("cust_info.csv", CUST), ("sales_details.csv", SALES), ("cust_az12.csv", AZ12),
                       ("loc_a101.csv", LOC), ("prd_info.csv", PRD), ("categories.csv", CAT)):
        (d / name).write_text(text)
    files = {"crm_cust_info": "cust_info.csv", "crm_prd_info": "prd_info.csv", "crm_sales_details": "sales_details.csv",
             "erp_loc_a101": "loc_a101.csv", "erp_cust_az12": "cust_az12.csv", "erp_px_cat_g1v2": "categories.csv"}
    root = str(tmp_path_factory.mktemp("fixed_root"))
    snap = []
    for _ in range(2):
        w = refresh_from_csv(spark, str(d), root, "2025-06-01", files=files)
        snap.append({t: sorted(map(tuple, w.gold[t].collect()), key=str) for t in w.gold})
    assert snap[0] == snap[1] and len(snap[0]["dim_products"]) == 4


def _multi_line(spark, path, table):
    """The same extract by Spark's reader, one task a file."""
    from tierwise.sources.schemas import BRONZE
    return spark.read.schema(BRONZE[table]).options(
        header=True, mode="FAILFAST", multiLine=True, quote='"', escape='"', nullValue="no such text", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_in_a_split_file(spark, tmp_path, end):
    import random

    from tierwise.sources.bronze import read_all_bronze
    rnd = random.Random(5)
    fields = ["plain", '"two\nlines"', '"a,b"', '"q""q"', '""', "", '"\n\n"', '"""\n"""', "\u0001", '"x\r\ny"', " sp ", "é"]
    for part in range(2):
        lines = ["cid,cntry"] + [f"AW-{part}{i:07d}," + rnd.choice(fields) for i in range(15_000)]
        lines[7_000] = 'long,"' + "line\n" * 30_000 + '"'                  # covers several blocks
        (tmp_path / f"{part}.csv").write_text(end.join(lines) + end, newline="")
    conf = {"spark.sql.files.maxPartitionBytes": "32768", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = read_all_bronze(spark, str(tmp_path), {"erp_loc_a101": ""})["erp_loc_a101"]
        tasks = df.groupBy(F.spark_partition_id()).count().count()
        got, want = df.collect(), _multi_line(spark, str(tmp_path), "erp_loc_a101").collect()
        assert tasks >= 8 and len(got) == 30_000
        assert any(r.cntry == "\u0001" for r in got) and any(r.cntry == "x\r\ny" for r in got)
        # Spark's reader takes "\r\n" inside quotes for "\n" in such files; COPY, and this reader, keep it.
        got, want = ([(r.cid, r.cntry and r.cntry.replace("\r\n", "\n")) for r in x] for x in (got, want))
        assert sorted(map(str, got)) == sorted(map(str, want))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_records_of_blank_and_broken_files(spark, tmp_path):
    from tierwise.sources.records import csv_records
    texts = {"empty": "", "header": "a,b\n", "blank": 'a,b\n\n1,2\r\n\n"\n",4\n\n', "no_end": "a,b\n1,2"}
    want = {"empty": [], "header": [], "blank": ["1,2", '"\n",4'], "no_end": ["1,2"]}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
        assert sorted(r.value for r in csv_records(spark, str(tmp_path / name)).collect()) == sorted(want[name])
    assert [r.value for r in csv_records(spark, str(tmp_path / "no_end"), header=False).collect()] == ["a,b", "1,2"]
