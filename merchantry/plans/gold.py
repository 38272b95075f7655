"""Star schema: two dimensions with dense surrogate keys and one fact."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import UNKNOWN
from ..functions import EXACT, collated
from ..operators import left_lookup, surrogate_key
from ..schemas import GOLD
from ..session import scratch, unsorted_rows, workspace
from ..sources.tables import CODEC, Release, read_table
from .silver import read_silver


# Column that a stored fact is laid out by.
YEAR = "order_year"


def enriched_customers(
    customers: DataFrame, erp_customers: DataFrame, locations: DataFrame
) -> DataFrame:
    """Customers with their ERP attributes and location, both by customer key.

    The second lookup goes by a column of its own. Two joins in a row on one
    column share a shuffle, and adaptive execution does not split a hot key
    where a later join relies on the partitioning.
    """
    erp = erp_customers.select(F.col("cid").alias("_erp_cid"), "bdate", "gen")
    places = locations.select(F.concat(F.lit("#"), "cid").alias("_place_cid"), "cntry")
    with_place_key = customers.withColumn("_place_key", F.concat(F.lit("#"), "cst_key"))
    return left_lookup(
        left_lookup(with_place_key, erp, "cst_key", "_erp_cid"), places, "_place_key", "_place_cid"
    )


def gold_customers(
    customers: DataFrame, erp_customers: DataFrame, locations: DataFrame
) -> DataFrame:
    """Customer dimension, numbered by customer id.

    The CRM gender counts; where it is unknown the ERP gender stands in.
    """
    joined = enriched_customers(customers, erp_customers, locations)
    gender = F.when(F.col("cst_gndr") != UNKNOWN, F.col("cst_gndr")).otherwise(
        F.coalesce("gen", F.lit(UNKNOWN))
    )
    dimension = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        gender.alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )
    return surrogate_key(dimension, ["customer_id"], "customer_key")


def gold_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product dimension: current versions, numbered by start date and product number."""
    current = products.where(F.col("prd_end_dt").isNull())
    joined = left_lookup(current, categories, "cat_id", "id")
    dimension = joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    return surrogate_key(dimension, ["start_date", "product_number"], "product_key")


def gold_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales fact: business keys exchanged for the keys of the stored dimensions.

    Customers come first: lines of an order mostly stand together and have one
    customer, so they stay together on that shuffle and compress well there.
    """
    product_keys = products.select("product_key", "product_number")
    customer_keys = customers.select("customer_key", "customer_id")
    joined = left_lookup(
        left_lookup(sales, customer_keys, "sls_cust_id", "customer_id").drop("customer_id"),
        product_keys,
        "sls_prd_key",
        "product_number",
    )
    return joined.select(
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


def store_fact(sales: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The fact, and the folder it is stored in, by order year, and in each year in buckets of order numbers.

    Lines without a date are a partition of their own, so whoever asks for dated
    lines does not read them. All lines of an order are in one bucket, so orders
    are counted without a shuffle. There are as many buckets as the session has
    shuffle partitions; a task writes one bucket, a file for each year. The year is
    taken after the shuffle, and the rows are not sorted for it.
    """
    spark = sales.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}"
    path = f"{workspace(spark)}/{name}"
    laid_out = sales.repartition(buckets, "order_number").withColumn(YEAR, F.year("order_date"))
    with unsorted_rows(spark):
        (
            laid_out.write.partitionBy(YEAR)
            .bucketBy(buckets, "order_number")
            .option("path", path)
            .saveAsTable(name, compression=CODEC)
        )
    return spark.table(name), path


def load_gold(
    spark: SparkSession, silver_dir: str, gold_dir: str, collation: str | None = None
) -> None:
    """Store the dimensions side by side, then the fact on top of them, and release the three at once.

    Keys are numbered anew by every load, so the fact is built against the
    dimensions of the same release, and readers never see one without the other.
    Keys are compared under ``collation`` (default: by exact characters); the stored
    columns are plain strings.
    """

    def silver(table: str) -> DataFrame:
        return collated(read_silver(spark, silver_dir, table), collation)

    def plain(df: DataFrame) -> DataFrame:
        return collated(df, collation and EXACT)

    with Release(spark, gold_dir) as release, scratch(spark):
        release.write_all(
            {
                "customers": lambda: plain(
                    gold_customers(
                        silver("crm_cust_info"), silver("erp_cust_az12"), silver("erp_loc_a101")
                    )
                ),
                "products": lambda: plain(
                    gold_products(silver("crm_prd_info"), silver("erp_px_cat_g1v2"))
                ),
            }
        )
        sales = gold_sales(
            silver("crm_sales_details"),
            collated(release.read("products", GOLD["products"]), collation),
            release.read("customers", GOLD["customers"]),
        )
        with unsorted_rows(spark):
            release.write(plain(sales), "sales")
        release.publish()


def read_gold(spark: SparkSession, gold_dir: str, table: str) -> DataFrame:
    """Scan of a star-schema table."""
    return read_table(spark, f"{gold_dir}/{table}", GOLD[table])
