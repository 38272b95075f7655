from datetime import date, datetime

from helpers import bronze_rows, counted, rows_of
from pyspark.sql import functions as F

from merchantry.plans import gold, silver
from test_silver import delivered_products


def frames(spark):
    customers = spark.createDataFrame(
        [(i, f"AW{i}", "First", "Last", "Single", g, date(2020, 1, i)) for i, g in
         [(3, "n/a"), (1, "Male"), (2, "n/a"), (4, None)]],
        "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string,"
        " cst_marital_status string, cst_gndr string, cst_create_date date",
    )
    erp = spark.createDataFrame(
        [("AW1", date(1980, 1, 1), "Female"), ("AW2", None, "Female"), ("AW4", None, "Male")],
        "cid string, bdate date, gen string",
    )
    places = spark.createDataFrame([("AW3", "France")], "cid string, cntry string")
    return customers, erp, places


def test_customer_dimension(spark):
    df = gold.gold_customers(*frames(spark)).orderBy("customer_key")
    found = df.select("customer_key", "customer_id", "gender", "country", "birthdate")
    assert rows_of(found) == [
        (1, 1, "Male", None, date(1980, 1, 1)),
        (2, 2, "Female", None, None),
        (3, 3, "n/a", "France", None),
        (4, 4, "Male", None, None),
    ]


def test_a_repeated_erp_id_repeats_the_customer_under_another_key(spark):
    customers, erp, places = frames(spark)
    df = gold.gold_customers(customers, erp, places.union(places))
    assert sorted((r.customer_key, r.customer_id) for r in df.collect()) == [
        (1, 1), (2, 2), (3, 3), (4, 3), (5, 4)
    ]


def test_product_dimension_of_delivered_rows(spark):
    categories = spark.createDataFrame(
        [("CO_RF", "Components", "Road Frames", "Yes"), ("AC_HE", "Accessories", "Helmets", "Yes"),
         ("BI_MB", "Bikes", "Mountain Bikes", "Yes"), ("CO_PD", "Components", "Pedals", "No")],
        "id string, cat string, subcat string, maintenance string",
    )
    df = gold.gold_products(silver.silver_products(delivered_products(spark)), categories)
    found = df.orderBy("product_key").select("product_key", "product_id", "category", "subcategory")
    assert rows_of(found) == [
        (1, 210, "Components", "Road Frames"),
        (2, 348, "Bikes", "Mountain Bikes"),
        (3, 214, "Accessories", "Helmets"),
        (4, 542, None, None),
    ]


def sales_rows(spark):
    return silver.silver_sales(
        bronze_rows(
            spark,
            "crm_sales_details",
            {"sls_ord_num": "SO1", "sls_prd_key": "X", "sls_cust_id": 7, "sls_order_dt": 20200102,
             "sls_sales": 10, "sls_quantity": 1, "sls_price": 10},
            {"sls_ord_num": "SO2", "sls_prd_key": "?", "sls_cust_id": 8, "sls_quantity": 1},
            {"sls_ord_num": "SO3"},
        )
    )


def test_fact_keeps_unmatched_lines(spark):
    products = spark.createDataFrame([(5, "X"), (6, None)], "product_key bigint, product_number string")
    customers = spark.createDataFrame([(9, 7), (10, None)], "customer_key bigint, customer_id bigint")
    df = gold.gold_sales(sales_rows(spark), products, customers)
    found = df.select("order_number", "product_key", "customer_key", "order_date", "sales_amount")
    assert sorted(rows_of(found)) == [
        ("SO1", 5, 9, date(2020, 1, 2), 10),
        ("SO2", None, None, None, None),
        ("SO3", None, None, None, None),
    ]


def test_two_products_of_one_number_give_two_lines(spark):
    products = spark.createDataFrame([(5, "X"), (6, "X")], "product_key bigint, product_number string")
    customers = spark.createDataFrame([(9, 7)], "customer_key bigint, customer_id bigint")
    df = gold.gold_sales(sales_rows(spark), products, customers)
    assert sorted(r.product_key for r in df.where("order_number = 'SO1'").collect()) == [5, 6]


def test_product_intervals_do_not_overlap(spark):
    rows = [
        {"prd_id": i, "prd_key": f"AA-BB-{i % 3}", "prd_start_dt": datetime(2000 + i, 1, 1)}
        for i in range(30)
    ]
    df = silver.silver_products(bronze_rows(spark, "crm_prd_info", *rows)).alias("a")
    overlap = df.join(
        df.alias("b"),
        (F.col("a.prd_key") == F.col("b.prd_key"))
        & (F.col("a.prd_start_dt") < F.col("b.prd_start_dt"))
        & (F.coalesce("a.prd_end_dt", F.lit("9999-12-31").cast("date")) >= F.col("b.prd_start_dt")),
    )
    assert overlap.count() == 0
    assert counted(df.select("prd_key").where("prd_end_dt IS NULL")).total() == 3
