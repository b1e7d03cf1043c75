"""Declared schemas of the three layers.

Bronze mirrors the two source systems' extracts (CRM, ERP) column for column;
CSV files are read positionally against these schemas, never inferred.
Width limits of the source DDL (50 characters per text column) are enforced on load
where asked for, and checked by the data-quality suite (K15) in any case.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DateType()
TS = T.TimestampNTZType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


BRONZE: dict[str, T.StructType] = {
    "crm_cust_info": _struct(("cst_id", I), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
                             ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", D)),
    "crm_prd_info": _struct(("prd_id", I), ("prd_key", S), ("prd_nm", S), ("prd_cost", I), ("prd_line", S),
                            ("prd_start_dt", TS), ("prd_end_dt", TS)),
    "crm_sales_details": _struct(("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", I), ("sls_order_dt", I),
                                 ("sls_ship_dt", I), ("sls_due_dt", I), ("sls_sales", I), ("sls_quantity", I),
                                 ("sls_price", I)),
    "erp_loc_a101": _struct(("cid", S), ("cntry", S)),
    "erp_cust_az12": _struct(("cid", S), ("bdate", D), ("gen", S)),
    "erp_px_cat_g1v2": _struct(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}

# Keys by which single rows of a table (bronze or silver) are looked up.
LOOKUP_KEYS: dict[str, tuple[str, ...]] = {
    "crm_cust_info": ("cst_id", "cst_key"),
    "crm_prd_info": ("prd_id", "prd_key"),
    "crm_sales_details": ("sls_ord_num", "sls_cust_id"),
}

# Source file of each bronze table, relative to the landing folder. The
# category file ships upper-case, so the name is configuration, not a guess.
BRONZE_FILES: dict[str, str] = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}

AUDIT_COL = "dwh_create_date"

TEXT_WIDTH = 50
V, L = T.VarcharType(TEXT_WIDTH), T.LongType()

# Contracts of silver and gold: enforced by store assignment when a table is written. Ids are BIGINT, wider than the source's
# INTEGER, so that sparse 64-bit ids load; the types that the load changes (dates, the product key's split) are the loaded ones.
SILVER: dict[str, T.StructType] = {t: _struct(*cols, (AUDIT_COL, TS)) for t, cols in {
    "crm_cust_info": [("cst_id", L), ("cst_key", V), ("cst_firstname", V), ("cst_lastname", V), ("cst_marital_status", V),
                      ("cst_gndr", V), ("cst_create_date", D)],
    "crm_prd_info": [("prd_id", L), ("cat_id", V), ("prd_key", V), ("prd_nm", V), ("prd_cost", I), ("prd_line", V),
                     ("prd_start_dt", D), ("prd_end_dt", D)],
    "crm_sales_details": [("sls_ord_num", V), ("sls_prd_key", V), ("sls_cust_id", L), ("sls_order_dt", D), ("sls_ship_dt", D),
                          ("sls_due_dt", D), ("sls_sales", I), ("sls_quantity", I), ("sls_price", I)],
    "erp_loc_a101": [("cid", V), ("cntry", V)],
    "erp_cust_az12": [("cid", V), ("bdate", D), ("gen", V)],
    "erp_px_cat_g1v2": [("id", V), ("cat", V), ("subcat", V), ("maintenance", V)],
}.items()}

GOLD: dict[str, T.StructType] = {
    "dim_customers": _struct(("customer_key", L), ("customer_id", L), ("customer_number", V), ("first_name", V),
                             ("last_name", V), ("gender", V), ("birthdate", D), ("marital_status", V), ("country", V),
                             ("create_date", D)),
    "dim_products": _struct(("product_key", L), ("product_id", L), ("product_number", V), ("product_name", V),
                            ("category_id", V), ("category", V), ("subcategory", V), ("maintenance", V), ("cost", I),
                            ("product_line", V), ("start_date", D)),
    "fact_sales": _struct(("order_number", V), ("product_key", L), ("customer_key", L), ("order_date", D),
                          ("shipping_date", D), ("due_date", D), ("sales_amount", I), ("quantity", I), ("price", I)),
}

SILVER_COLUMNS: dict[str, list[str]] = {t: [c for c in s.names if c != AUDIT_COL] for t, s in SILVER.items()}
GOLD_COLUMNS: dict[str, list[str]] = {t: s.names for t, s in GOLD.items()}
# Width of every text column of a table's extract.
BRONZE_WIDTHS: dict[str, dict[str, int]] = {t: {f.name: TEXT_WIDTH for f in s.fields if f.dataType == S} for t, s in BRONZE.items()}


def stored(schema: T.StructType) -> T.StructType:
    """The types under which files hold a declared schema: VARCHAR is text, its width is checked on load."""
    return T.StructType([T.StructField(f.name, S if isinstance(f.dataType, T.VarcharType) else f.dataType, f.nullable)
                         for f in schema.fields])
