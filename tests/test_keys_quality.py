import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierwise.operators import quality as K
from tierwise.operators.keys import sorted_ranges, with_surrogate_key


def row_numbers(df, order, name):
    """The same numbering by one global window."""
    return df.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias(name), *df.columns)


def test_scalable_key_matches_global_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.choice([None, 1, 2, 3, 4]), rnd.randint(0, 50) if rnd.random() > 0.1 else None, i)
            for i in range(1000)]
    df = spark.createDataFrame(data, "a int, b int, id int")
    order = [F.col("a").asc_nulls_last(), F.col("b").desc_nulls_first(), F.col("id").asc_nulls_last()]
    fast = {r.id: r.k for r in with_surrogate_key(df, order, "k").collect()}
    slow = {r.id: r.k for r in row_numbers(df, order, "k").collect()}
    assert fast == slow
    assert sorted(fast.values()) == list(range(1, 1001))


def _ranges_used(spark, df, order):
    """Rows of the fullest range and number of ranges, without coalescing of small partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in sorted_ranges(df, order, "p", "at").groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return max(sizes), len(sizes)


def test_every_shape_of_key_numbers_in_many_tasks(spark):
    n = 20_000
    sparse = spark.range(n).select((F.xxhash64("id") * 1).alias("customer_id"), "id")
    bulk = spark.range(n).select(F.lit("2011-07-01").cast("date").alias("start_date"),
                                 F.format_string("AB-%08d", F.col("id")).alias("product_number"), "id")
    alike = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("a"))
    for df, order in ((sparse, [F.col("customer_id").asc_nulls_last()]),
                      (bulk, [F.col("start_date").asc_nulls_last(), F.col("product_number").asc_nulls_last()]),
                      (alike, [F.col("a")])):
        largest, ranges = _ranges_used(spark, df, order)
        assert ranges == 8 and largest < n / 4
        got = with_surrogate_key(df, order, "k")
        assert got.agg(F.count_distinct("k"), F.min("k"), F.max("k")).first() == (n, 1, n)
        cols = [c for c in df.columns if c != "id"]
        want = row_numbers(df, order, "k")
        assert got.select("k", *cols).exceptAll(want.select("k", *cols)).count() == 0


def test_keys_of_empty_and_clashing_tables(spark):
    df = spark.createDataFrame([(3, "x"), (None, "y"), (1, "z")], "_tie int, _part string")
    got = with_surrogate_key(df, [F.col("_tie").asc_nulls_last()], "k")
    assert sorted((r.k, r._tie) for r in got.collect() if r._tie) == [(1, 1), (2, 3)] and got.columns == ["k", "_tie", "_part"]
    assert with_surrogate_key(df.where("false"), [F.col("_tie")], "k").count() == 0


def test_product_keys_follow_a_collation(spark):
    from tierwise.plans.gold import dim_products
    numbers = ["a-1", "B-1", "b-1", "A-1", "ä-1", "z-1", None]
    products = spark.createDataFrame([(i, "X", n, "name", 1, "Road") for i, n in enumerate(numbers)],
                                     "prd_id long, cat_id string, prd_key string, prd_nm string, prd_cost int, prd_line string") \
        .withColumns({"prd_start_dt": F.lit("2011-07-01").cast("date"), "prd_end_dt": F.lit(None).cast("date")})
    silver = {"crm_prd_info": products, "erp_px_cat_g1v2": spark.createDataFrame([], "id string, cat string, subcat string, maintenance string")}

    def order(**kw):
        out = dim_products(silver, **kw)
        assert dict(out.dtypes)["product_number"] == "string"
        return [r.product_number for r in sorted(out.collect(), key=lambda r: r.product_key)]
    assert order() == ["A-1", "B-1", "a-1", "b-1", "z-1", "ä-1", None]
    assert order(collation="UNICODE") == ["a-1", "A-1", "ä-1", "b-1", "B-1", "z-1", None]
    assert order(collation="UTF8_LCASE")[:4] == ["A-1", "a-1", "B-1", "b-1"]       # equal under it, then bytewise


def _not_in_brute(child, parent):
    if not parent:
        return list(child)
    if any(p is None for p in parent):
        return []
    return [c for c in child if c is not None and c not in parent]


def test_not_in_semantics(spark):
    cases = [([1, 2, None, 3], [2]), ([1, None], []), ([1, 2], [None, 1]), ([None], [1]), ([5, 6], [5, 6])]
    for child, parent in cases:
        c = spark.createDataFrame([(v,) for v in child], "k int")
        p = spark.createDataFrame([(v,) for v in parent], "pk int")
        got = sorted((r.k for r in K.orphans_not_in(c, "k", p, "pk").collect()), key=lambda v: (v is None, v))
        want = sorted(_not_in_brute(child, parent), key=lambda v: (v is None, v))
        assert got == want, (child, parent)
        c.createOrReplaceTempView("c")
        p.createOrReplaceTempView("p")
        sql = sorted((r.k for r in spark.sql("SELECT k FROM c WHERE k NOT IN (SELECT pk FROM p)").collect()),
                     key=lambda v: (v is None, v))
        assert got == sql


def test_orphans_keeps_null_keys(spark):
    f = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    d = spark.createDataFrame([(1,)], "k int")
    assert sorted((r.k for r in K.orphans(f, "k", d).collect()), key=lambda v: (v is None, v)) == [9, None]


def test_duplicates_and_bad_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert [r.k for r in K.duplicates(df, ["k"]).collect()] == [1]
    assert sorted((r.k for r in K.bad_keys(df, ["k"]).collect()), key=lambda v: (v is None, v)) == [1, None]


def test_untrimmed_and_too_long(spark):
    df = spark.createDataFrame([(" a", "b"), ("c", "x" * 51)], "s string, t string")
    assert [tuple(r) for r in K.untrimmed(df, ["s", "t"]).collect()] == [("s", " a")]
    assert [r.column for r in K.too_long(df, ["s", "t"]).collect()] == ["t"]


def test_validity_end_matches_window(spark):
    import datetime as dt

    from tierwise.operators.cleansing import add_valid_to
    rnd = random.Random(11)
    base = dt.datetime(2000, 1, 1)
    rows = []
    for i in range(1500):
        key = "HOT" if i % 3 == 0 else rnd.choice([None, "A", "B", "C", "D"])   # one key holds a third
        start = None if rnd.random() < 0.05 else base + dt.timedelta(days=rnd.randint(0, 400))
        rows.append((i, key, start))
    df = spark.createDataFrame(rows, "prd_id int, prd_key string, prd_start_dt timestamp_ntz")
    from pyspark.sql import Window
    fast = {r.prd_id: r.end for r in add_valid_to(df, "prd_key", "prd_start_dt", "end", ["prd_id"]).collect()}
    w = Window.partitionBy("prd_key").orderBy(F.col("prd_start_dt").asc_nulls_last(), "prd_id")
    plain = df.withColumn("end", (F.lead("prd_start_dt").over(w) - F.expr("INTERVAL 1 DAY")).cast("date"))
    assert fast == {r.prd_id: r.end for r in plain.collect()} and len(fast) == 1500


def test_duplicated_customer_gets_deterministic_keys(spark):
    import datetime as dt

    from tierwise.plans.gold import dim_customers
    ci = spark.createDataFrame([(1, "A1", "Ann", "Lee", "Single", "Unknown", dt.date(2020, 1, 1)),
                                (2, "A2", "Bo", "Li", "Married", "Male", None)],
                               "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
                               "cst_marital_status string, cst_gndr string, cst_create_date date")
    ca = spark.createDataFrame([("A1", None, "Male"), ("A1", None, "Female")], "cid string, bdate date, gen string")
    la = spark.createDataFrame([("A1", "Germany"), ("A2", "France")], "cid string, cntry string")
    silver = {"crm_cust_info": ci, "erp_cust_az12": ca, "erp_loc_a101": la}
    got = {(r.customer_id, r.gender): r.customer_key for r in dim_customers(silver).collect()}
    assert got == {(1, "Female"): 1, (1, "Male"): 2, (2, "Male"): 3}


def test_null_keys_of_every_type_find_nothing(spark):
    from tierwise.plans.gold import lookup_key
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for kind in ("int", "bigint", "string"):
            df = spark.createDataFrame([(1, 7), (2, None), (3, 8), (4, None)], "id int, k int") \
                .withColumn("k", F.col("k").cast(kind))
            dim = spark.createDataFrame([(70, 7), (99, None)], "sk int, k int").withColumn("k", F.col("k").cast(kind))
            got = {r.id: r.sk for r in lookup_key(df, "k", dim, "k", "sk").collect()}
            assert got == {1: 70, 2: None, 3: None, 4: None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
