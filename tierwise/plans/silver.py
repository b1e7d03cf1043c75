"""Bronze -> silver loads (E13-E18), one plan per table.

Only two loads shuffle: customers (latest row per id) and products (next
version's start per product key). The rest are projections that run in the
scan stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import as_of_col, null_future_dates
from ..operators import cleansing as C
from ..sources.schemas import SILVER_COLUMNS


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Latest row per ``cst_id`` (a NULL create date wins, as under DESC), trimmed names, decoded codes."""
    latest = C.latest_per_key(
        bronze, ["cst_id"],
        order=[F.col("cst_create_date").desc_nulls_first()],
        # deterministic tie-break on the remaining columns (source ties are arbitrary)
        tiebreak=[F.col(c).asc_nulls_last() for c in ("cst_marital_status", "cst_gndr", "cst_key",
                                                      "cst_firstname", "cst_lastname")],
    )
    trimmed = C.trim_columns(latest, ["cst_firstname", "cst_lastname"])
    return trimmed.select(
        "cst_id", "cst_key", "cst_firstname", "cst_lastname",
        C.standardise_marital("cst_marital_status").alias("cst_marital_status"),
        C.standardise_gender("cst_gndr").alias("cst_gndr"),
        "cst_create_date",
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    """Split key, cost default 0, line label, validity end from the next start."""
    # LEAD on the full source key; prd_id breaks ties between versions with the same start.
    with_end = C.add_valid_to(bronze, "prd_key", "prd_start_dt", "_valid_to", tiebreak=["prd_id"])
    split = C.split_product_key(with_end, "prd_key")
    return split.select(
        "prd_id", "cat_id", "prd_key", "prd_nm",
        C.zero_if_null("prd_cost").alias("prd_cost"),
        C.standardise_line("prd_line").alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        F.col("_valid_to").alias("prd_end_dt"),
    )


def silver_sales(bronze: DataFrame) -> DataFrame:
    """Decode integer dates, repair sales and price."""
    repaired = C.repair_sales(bronze)
    decoded = C.encoded_dates_to_date(repaired, ["sls_order_dt", "sls_ship_dt", "sls_due_dt"])
    return decoded.select(*SILVER_COLUMNS["crm_sales_details"])


def silver_erp_customers(bronze: DataFrame, as_of=None, fix_gender_case: bool = False) -> DataFrame:
    """Strip 'NAS', null future birth dates, normalise gender."""
    return bronze.select(
        C.repair_customer_id("cid").alias("cid"),
        null_future_dates("bdate", as_of_col(as_of)).alias("bdate"),
        C.standardise_erp_gender("gen", fix_gender_case).alias("gen"),
    )


def silver_locations(bronze: DataFrame) -> DataFrame:
    """Remove dashes from the key, standardise country."""
    return bronze.select(C.repair_location_id("cid").alias("cid"),
                         C.standardise_country("cntry").alias("cntry"))


def silver_categories(bronze: DataFrame) -> DataFrame:
    """Pass-through."""
    return bronze.select(*SILVER_COLUMNS["erp_px_cat_g1v2"])


def build_silver_table(table: str, bronze: DataFrame, as_of=None, fix_gender_case: bool = False) -> DataFrame:
    """The silver load of one table from its bronze extract."""
    if table == "erp_cust_az12":
        return silver_erp_customers(bronze, as_of, fix_gender_case)
    return {
        "crm_cust_info": silver_customers,
        "crm_prd_info": silver_products,
        "crm_sales_details": silver_sales,
        "erp_loc_a101": silver_locations,
        "erp_px_cat_g1v2": silver_categories,
    }[table](bronze)

