"""Binding of the shared TPC-H-like tables to the six bronze extracts.

The warehouse ingests CRM and ERP extracts. The shared test data is a
TPC-H-like star (customer, orders, lineitem, part, nation), so this module
derives bronze-shaped DataFrames from it with plain projections and joins,
so every derived table grows with the input. Dirty values that exercise the silver rules are
taken from natural attributes of the rows (discount, tax, market segment,
order status), never from filters: unknown and missing customers and products
among the sales lines, missing and repeated product ids, versions of a product
that start on one day, categories listed twice, ERP rows without or with
several CRM customers, untrimmed and over-long text. Sales lines left-join their
order and part, so every line item reaches bronze.

The same derivation is written in SQL in :mod:`tierwise.plans.oracle`, so
both engines start from identical bronze rows.

  crm_cust_info      one CRM profile snapshot per order (orders x customer);
                     the silver load keeps the newest per customer
  erp_cust_az12      one row per customer: key with/without 'NAS' prefix,
                     birth date from the account balance, raw gender text
  erp_loc_a101       one row per customer: dashed key, raw country code
  crm_prd_info       one version per part; parts sharing a name are versions
                     of one product, ordered by a start timestamp
  erp_px_cat_g1v2    one row per (thing, colour) category of the part names
  crm_sales_details  one row per line item (lineitem x orders x part)
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import date_to_int

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the binding (shared with the SQL oracle).
BIRTH_EPOCH = "1940-01-01"      # birth date = epoch + floor(acctbal * 2.6) days
BIRTH_DAYS_PER_UNIT = 2.6
START_EPOCH = "1990-01-01 00:00:00"
START_CYCLE_DAYS = 7300         # start = epoch + (partkey % cycle) days + (partkey div cycle) seconds
DUE_DAYS = 90                   # due date = order date + 90 days


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet")) for n in names}


def _customer_number(key: Column, prefix: str = "AW") -> Column:
    # Padded as printf's %08d pads, which never truncates long keys; printf itself, slow by row, is left what has no digits or a sign.
    digits = key.cast("string")
    return F.when(key >= 0, F.concat(F.lit(prefix), F.repeat(F.lit("0"), 8 - F.length(digits)), digits)) \
        .otherwise(F.format_string(f"{prefix}%08d", key))


def crm_cust_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_custkey", "o_orderstatus", "o_orderdate")
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_custkey").alias("cst_id"),
        _customer_number(F.col("c_custkey")).alias("cst_key"),
        F.concat(F.lit(" "), F.repeat(F.substring_index("c_name", "#", 1),
                                      F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(7)).otherwise(F.lit(1))))
         .alias("cst_firstname"),
        F.concat(F.substring_index("c_name", "#", -1), F.lit(" ")).alias("cst_lastname"),
        F.when(F.col("o_orderstatus") == "F", F.lit(" s"))
         .when(F.col("o_orderstatus") == "O", F.lit("M "))
         .otherwise(F.lit(None).cast("string")).alias("cst_marital_status"),
        F.concat(F.lit(" "), F.lower(F.substring("c_mktsegment", 1, 1)), F.lit(" ")).alias("cst_gndr"),
        F.col("o_orderdate").cast("date").alias("cst_create_date"),
    )


def erp_cust_az12(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    nk = F.col("c_nationkey")
    # Nation 5's households have keys that no CRM customer has; nation 6's share the key of an even neighbour.
    key = (F.when((nk == 5) & (seg == "HOUSEHOLD"), _customer_number(F.col("c_custkey"), "ZZ"))
           .when((nk == 6) & (seg == "HOUSEHOLD"), _customer_number(F.col("c_custkey") - F.col("c_custkey") % 2))
           .otherwise(_customer_number(F.col("c_custkey"))))
    return customer.select(
        F.when(seg.isin("BUILDING", "AUTOMOBILE"), F.concat(F.lit("NAS"), key)).otherwise(key).alias("cid"),
        F.date_add(F.lit(BIRTH_EPOCH).cast("date"),
                   F.floor(F.col("c_acctbal") * F.lit(BIRTH_DAYS_PER_UNIT)).cast("int")).alias("bdate"),
        F.when(seg == "FURNITURE", F.lit("F "))
         .when(seg == "MACHINERY", F.lit(" Male"))
         .when(seg == "HOUSEHOLD", F.lit("Female"))
         .when(seg == "BUILDING", F.lit("m"))
         .otherwise(F.lit("")).alias("gen"),
    )


def erp_loc_a101(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    nk = F.col("n_nationkey")
    return j.select(
        _customer_number(F.col("c_custkey"), "AW-").alias("cid"),
        F.when(nk == 0, F.lit("DE")).when(nk == 1, F.lit("US")).when(nk == 2, F.lit(" USA "))
         .when(nk == 3, F.lit("")).when(nk == 4, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.col("n_name"))).alias("cntry"),
    )


def _thing() -> Column:
    return F.substring_index("p_name", " ", -1)


def _colour() -> Column:
    return F.substring_index("p_name", " ", 1)


def _category_code(sep: str) -> Column:
    return F.concat(F.upper(F.substring(_thing(), 1, 2)), F.lit(sep), F.upper(F.substring(_colour(), 1, 2)))


def product_number(name: Column | str = "p_name") -> Column:
    return F.upper(F.replace(F.col(name) if isinstance(name, str) else name, F.lit(" "), F.lit("-")))


def _capitalise(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def crm_prd_info(part: DataFrame) -> DataFrame:
    # Parts of sizes 45 to 47 start within one day, one second per key.
    start = F.expr(
        f"CASE WHEN p_size BETWEEN 45 AND 47 THEN timestampadd(SECOND, p_partkey % 86400, TIMESTAMP_NTZ'{START_EPOCH}') "
        f"ELSE timestampadd(SECOND, p_partkey div {START_CYCLE_DAYS}, "
        f"timestampadd(DAY, p_partkey % {START_CYCLE_DAYS}, TIMESTAMP_NTZ'{START_EPOCH}')) END")
    return part.select(
        F.when(F.col("p_size") == 49, F.lit(None)).when(F.col("p_size") == 48, F.col("p_partkey") - 1)
         .otherwise(F.col("p_partkey")).alias("prd_id"),
        F.concat(_category_code("-"), F.lit("-"), product_number()).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(F.col("p_size") >= 50, F.lit(None).cast("int")).otherwise(F.col("p_size") * 40).alias("prd_cost"),
        F.concat(F.substring("p_type", 1, 1), F.lit(" ")).alias("prd_line"),
        start.alias("prd_start_dt"),
        F.when(F.col("p_retailprice") > 950, F.lit(None).cast("timestamp_ntz"))
         .otherwise(start - F.expr("INTERVAL 365 DAYS")).alias("prd_end_dt"),
    )


def erp_px_cat_g1v2(part: DataFrame) -> DataFrame:
    thing = _thing()
    return part.select(
        # Anvils are listed under codes that no product has.
        F.when(thing == "anvil", F.concat(F.lit("X"), _category_code("_"))).otherwise(_category_code("_")).alias("id"),
        _capitalise(thing).alias("cat"),
        F.concat(F.when(thing == "widget", F.lit(" ")).otherwise(F.lit("")), _capitalise(_colour())).alias("subcat"),
        # Gizmos of size 50 contradict the others: their category occurs twice.
        F.when(thing.isin("gear", "widget") | ((thing == "gizmo") & (F.col("p_size") != 50)), F.lit("Yes"))
         .otherwise(F.lit("No")).alias("maintenance"),
    ).distinct()


def crm_sales_details(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                         "l_shipdate")
    # What depends on the order or the part alone is computed once each, not per line.
    o = orders.select("o_orderkey", "o_custkey", date_to_int("o_orderdate").alias("order_int"),
                      date_to_int(F.date_add(F.col("o_orderdate").cast("date"), DUE_DAYS)).alias("due_int"))
    p = part.select("p_partkey", product_number().alias("number"), _thing().alias("thing"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left").join(p, li.l_partkey == p.p_partkey, "left")
    qty = F.col("l_quantity").cast("int")
    # Every tenth customer buys, and every widget sells, at a price of 1 (smaller tiers occur).
    cheap = (F.col("o_custkey") % 10 == 0) | (F.col("thing") == "widget")
    base = F.when(cheap, F.lit(1)).otherwise(F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int"))
    disc, tax = F.col("l_discount"), F.col("l_tax")
    order_int, number = F.col("order_int"), F.col("number")
    return j.select(
        F.concat(F.lit("SO"), F.col("l_orderkey").cast("string")).alias("sls_ord_num"),
        F.when((disc == 0.07) & (tax == 0.07), F.concat(F.lit("UNKNOWN-"), number))
         .when((disc == 0.08) & (tax == 0.07), F.lit(None)).otherwise(number).alias("sls_prd_key"),
        F.when((disc == 0.05) & (tax == 0.05), F.lit(None)).when((disc == 0.06) & (tax == 0.05), -F.col("o_custkey"))
         .otherwise(F.col("o_custkey")).alias("sls_cust_id"),
        F.when(disc == 0.0, F.lit(0)).when(disc == 0.1, F.call_function("div", order_int, F.lit(100)).cast("int"))
         .otherwise(order_int).alias("sls_order_dt"),
        date_to_int("l_shipdate").alias("sls_ship_dt"),
        F.col("due_int").alias("sls_due_dt"),
        F.when(disc == 0.01, F.lit(None).cast("int")).when(disc == 0.02, -(qty * base))
         .when(disc == 0.03, qty * base + 1).when(disc == 0.04, F.lit(0)).otherwise(qty * base).alias("sls_sales"),
        qty.alias("sls_quantity"),
        F.when(tax == 0.0, -base).when(tax == 0.08, F.lit(None).cast("int")).otherwise(base).alias("sls_price"),
    )


def bronze_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = load_tables(spark, sf_dir, ("customer", "orders", "lineitem", "part", "nation"))
    return {
        "crm_cust_info": crm_cust_info(t["orders"], t["customer"]),
        "crm_prd_info": crm_prd_info(t["part"]),
        "crm_sales_details": crm_sales_details(t["lineitem"], t["orders"], t["part"]),
        "erp_loc_a101": erp_loc_a101(t["customer"], t["nation"]),
        "erp_cust_az12": erp_cust_az12(t["customer"]),
        "erp_px_cat_g1v2": erp_px_cat_g1v2(t["part"]),
    }
