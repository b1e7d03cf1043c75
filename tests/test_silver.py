"""Silver rules on the hand-made dirty rows of FIXTURES.md section 3."""
import datetime as dt

from tierwise.plans import silver as S
from tierwise.sources.schemas import BRONZE

D, TS = dt.date, dt.datetime


def test_customers_latest_row(spark):
    data = [(1, "A1", " Ann ", "Lee", "S", "F", D(2025, 1, 1)),
            (1, "A1", "Ann", " Lee ", " m ", "f", D(2025, 2, 1)),
            (2, "A2", "Bo", None, None, None, D(2025, 1, 1)),
            (2, "A2", "Bob", None, "X", "", None),
            (None, "A3", "No", "Key", "S", "M", D(2025, 1, 1))]
    out = S.silver_customers(spark.createDataFrame(data, BRONZE["crm_cust_info"])).orderBy("cst_id").collect()
    assert [tuple(r) for r in out] == [
        (1, "A1", "Ann", "Lee", "Married", "Female", D(2025, 2, 1)),
        (2, "A2", "Bob", None, "Unknown", "Unknown", None)]


def test_sales_repair(spark):
    rows = [(20101229, 20, 2, 10), (0, None, 2, 10), (5489, 25, 2, 10), (None, 21, 2, -10), (20101229, 21, 2, None),
            (20101229, -5, 1, 0), (20101229, None, 2, -10), (20101229, 0, 2, None), (20101229, 20, 0, None)]
    data = [(f"SO{i}", "P", 1, d, 20110105, 20110110, s, q, p) for i, (d, s, q, p) in enumerate(rows)]
    out = S.silver_sales(spark.createDataFrame(data, BRONZE["crm_sales_details"])).orderBy("sls_ord_num").collect()
    got = [(r.sls_order_dt, r.sls_sales, r.sls_price) for r in out]
    d = D(2010, 12, 29)
    assert got == [(d, 20, 10), (None, 20, 10), (None, 20, 10), (None, 20, 10), (d, 21, 10), (d, 0, -5),
                   (d, 20, None), (d, None, 0), (d, 20, None)]


def test_products_versions(spark):
    data = [(212, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 12, "S ", TS(2011, 7, 1), TS(2007, 12, 28)),
            (213, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 14, "S ", TS(2012, 7, 1), TS(2008, 12, 27)),
            (214, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 13, "S ", TS(2013, 7, 1), None),
            (210, "CO-RF-FR-R92B-58", "HL Road Frame - Black- 58", None, "R ", TS(2003, 7, 1), None)]
    out = S.silver_products(spark.createDataFrame(data, BRONZE["crm_prd_info"])).orderBy("prd_id").collect()
    assert [(r.prd_id, r.cat_id, r.prd_key, r.prd_cost, r.prd_line, r.prd_start_dt, r.prd_end_dt) for r in out] == [
        (210, "CO_RF", "FR-R92B-58", 0, "Road", D(2003, 7, 1), None),
        (212, "AC_HE", "HL-U509-R", 12, "other Sales", D(2011, 7, 1), D(2012, 6, 30)),
        (213, "AC_HE", "HL-U509-R", 14, "other Sales", D(2012, 7, 1), D(2013, 6, 30)),
        (214, "AC_HE", "HL-U509-R", 13, "other Sales", D(2013, 7, 1), None)]


def test_erp_customers(spark):
    data = [("NASAW00011000", D(1971, 10, 6), "M "), ("AW00011001", D(2999, 1, 1), "f"),
            ("AW00011002", None, "Female"), ("AW00011003", D(2025, 6, 1), "")]
    df = spark.createDataFrame(data, BRONZE["erp_cust_az12"])
    out = S.silver_erp_customers(df, "2025-06-01").orderBy("cid").collect()
    assert [tuple(r) for r in out] == [("AW00011000", D(1971, 10, 6), "Male"), ("AW00011001", None, "Female"),
                                       ("AW00011002", None, "Unknown"), ("AW00011003", D(2025, 6, 1), "Unknown")]
    fixed = S.silver_erp_customers(df, "2025-06-01", fix_gender_case=True).orderBy("cid").collect()
    assert fixed[2].gen == "Female"


def test_locations(spark):
    data = [("AW-00011000", " DE"), ("AW-00011001", "USA"), ("AW-00011002", "  "), ("AW-00011003", None),
            ("AW-00011004", " France ")]
    out = S.silver_locations(spark.createDataFrame(data, BRONZE["erp_loc_a101"])).orderBy("cid").collect()
    assert [tuple(r) for r in out] == [("AW00011000", "Germany"), ("AW00011001", "United States"),
                                       ("AW00011002", "Unkown"), ("AW00011003", "Unkown"), ("AW00011004", "France")]
