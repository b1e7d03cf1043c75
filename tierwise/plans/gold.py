"""Silver -> gold star schema.

Dimensions get dense surrogate keys in business-key order; the fact swaps
business keys for surrogate keys with two left joins. The planner picks
broadcast vs shuffle joins from runtime sizes (AQE); nothing here forces a
broadcast of a table whose size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cleansing import UNKNOWN
from ..operators.keys import with_surrogate_key
from ..sources.schemas import GOLD_COLUMNS


def prefer_master(master: Column, fallback: Column, unknown: str = UNKNOWN) -> Column:
    """CRM value unless it is 'Unknown' (or NULL), else ERP, else 'Unknown' (G2)."""
    return F.when(master != F.lit(unknown), master).otherwise(F.coalesce(fallback, F.lit(unknown)))


def current_rows(df: DataFrame, end_col: str) -> DataFrame:
    """Current version only: open-ended validity."""
    return df.where(F.col(end_col).isNull())


def _key(df: DataFrame, leading: list[str], name: str, collation: str | None = None) -> DataFrame:
    """Number rows by ``leading`` (the source's key order), then by every other column so that
    duplicated business keys (which the quality suite reports) still get deterministic keys.

    Text ascends bytewise or under a ``collation`` such as UNICODE; texts that it takes for equal then follow bytewise (T10).
    """
    columns = leading + [c for c in df.columns if c not in leading]
    text = [c for c, kind in df.dtypes if kind == "string"] if collation else []
    order = [k for c in columns for k in ([F.collate(c, collation)] if c in text else []) + [F.col(c)]]
    return with_surrogate_key(df, [c.asc_nulls_last() for c in order], name)


def dim_customers(silver: dict[str, DataFrame], collation: str | None = None) -> DataFrame:
    """CRM customers enriched with ERP birth date, gender fallback and country."""
    ci = silver["crm_cust_info"].alias("ci")
    ca = silver["erp_cust_az12"].alias("ca")
    la = silver["erp_loc_a101"].alias("la")
    j = (ci.join(ca, F.col("ci.cst_key") == F.col("ca.cid"), "left")
           .join(la, F.col("ci.cst_key") == F.col("la.cid"), "left"))
    body = j.select(
        F.col("ci.cst_id").alias("customer_id"),
        F.col("ci.cst_key").alias("customer_number"),
        F.col("ci.cst_firstname").alias("first_name"),
        F.col("ci.cst_lastname").alias("last_name"),
        prefer_master(F.col("ci.cst_gndr"), F.col("ca.gen")).alias("gender"),
        F.col("ca.bdate").alias("birthdate"),
        F.col("ci.cst_marital_status").alias("marital_status"),
        F.col("la.cntry").alias("country"),
        F.col("ci.cst_create_date").alias("create_date"),
    )
    return _key(body, ["customer_id", "customer_number"], "customer_key", collation) \
        .select(*GOLD_COLUMNS["dim_customers"])


def dim_products(silver: dict[str, DataFrame], collation: str | None = None) -> DataFrame:
    """Current product versions with category attributes; keyed after the filter."""
    pn = current_rows(silver["crm_prd_info"], "prd_end_dt").alias("pn")
    pc = silver["erp_px_cat_g1v2"].alias("pc")
    body = pn.join(pc, F.col("pn.cat_id") == F.col("pc.id"), "left").select(
        F.col("pn.prd_id").alias("product_id"),
        F.col("pn.prd_key").alias("product_number"),
        F.col("pn.prd_nm").alias("product_name"),
        F.col("pn.cat_id").alias("category_id"),
        F.col("pc.cat").alias("category"),
        F.col("pc.subcat").alias("subcategory"),
        F.col("pc.maintenance").alias("maintenance"),
        F.col("pn.prd_cost").alias("cost"),
        F.col("pn.prd_line").alias("product_line"),
        F.col("pn.prd_start_dt").alias("start_date"),
    )
    return _key(body, ["start_date", "product_number", "product_id"], "product_key", collation) \
        .select(*GOLD_COLUMNS["dim_products"])


# Join keys over which rows without a business key are spread.
NULL_SALTS = 1024


def lookup_key(df: DataFrame, key: str, dim: DataFrame, dim_key: str, surrogate: str) -> DataFrame:
    """Left join ``df.key = dim.dim_key`` adding ``surrogate``, in one pass, NULL keys spread.

    The join runs on ``(salt, key)``: salt 0 on the dimension and for every row that has a key, and a deterministic
    hash of the row where the key is NULL. Such rows match nothing, as in the plain join, but don't all hash
    to one shuffle partition. Hot keys are split by AQE's skew-join handling.
    """
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(NULL_SALTS)).cast("int") + 1
    left = df.withColumn("_lk_salt", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0)))
    right = dim.select(F.col(surrogate), F.lit(0).alias("_dk_salt"), F.col(dim_key).alias("_dk_val"))
    cond = (F.col("_lk_salt") == F.col("_dk_salt")) & (F.col(key) == F.col("_dk_val"))
    return left.join(right, cond, "left").drop("_lk_salt", "_dk_salt", "_dk_val")


def fact_sales(silver: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Sales lines with surrogate keys looked up by business key (left joins)."""
    sd = silver["crm_sales_details"]
    j = lookup_key(sd, "sls_prd_key", dims["dim_products"], "product_number", "product_key")
    j = lookup_key(j, "sls_cust_id", dims["dim_customers"], "customer_id", "customer_key")
    return j.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )
