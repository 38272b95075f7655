"""Raw tables derived from order-processing sample tables.

The sample tables are clean; the expressions here bring in the dirt the
cleaning steps are there for, as a function of the keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE


# Lines of a delivered file at most.
LINES_PER_FILE = 1_000_000


def _padded(number: Column, width: int) -> Column:
    """Digits of a number, zeros in front up to ``width``, never cut."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def _by_remainder(number: Column, divisor: int, values: dict[int, object], otherwise=None) -> Column:
    result = F
    for remainder, value in values.items():
        result = result.when(number % divisor == remainder, value)
    return result.otherwise(otherwise)


def _day_number(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE[table].fields])


def _customer_key() -> Column:
    return F.concat(F.lit("AW"), _padded(F.col("c_custkey"), 8))


def raw_customers(read: Callable[[str], DataFrame]) -> DataFrame:
    """Customers, some without an id, and an older second row for one in ten."""
    customer = read("customer").select("c_custkey", "c_name")
    key = F.col("c_custkey")
    older = F.col("older")
    last_name = F.substring("c_name", 10, 9)
    rows = customer.withColumn(
        "older",
        F.explode(
            F.when(key % 10 == 3, F.array(F.lit(False), F.lit(True))).otherwise(
                F.array(F.lit(False))
            )
        ),
    ).select(
        F.when(older | (key % 97 != 96), key).alias("cst_id"),
        _customer_key().alias("cst_key"),
        F.when(~older, F.concat(F.lit("  "), F.substring("c_name", 1, 8))).alias("cst_firstname"),
        F.when(older, last_name).otherwise(F.concat(last_name, F.lit(" "))).alias("cst_lastname"),
        F.when(older, "S")
        .otherwise(_by_remainder(key, 4, {0: "S", 1: " m ", 2: "M"}))
        .alias("cst_marital_status"),
        F.when(older, "M")
        .otherwise(_by_remainder(key, 5, {0: "F", 1: " m", 2: "M ", 3: "f"}))
        .alias("cst_gndr"),
        F.when(older, F.date_add(F.lit("2009-01-01").cast("date"), (key % 300).cast("int")))
        .otherwise(F.date_add(F.lit("2010-01-01").cast("date"), (key % 1500).cast("int")))
        .alias("cst_create_date"),
    )
    return _conform(rows, "crm_cust_info")


def _category_id(separator: str) -> Column:
    brand = F.substring_index("p_brand", "#", -1)
    return F.concat(F.substring("p_type", 1, 2), F.lit(separator), _padded(brand, 2))


def raw_products(read: Callable[[str], DataFrame]) -> DataFrame:
    """Products in one, two or three versions."""
    part = read("part")
    key, version = F.col("p_partkey"), F.col("version")
    start = F.date_add(F.lit("1994-07-01").cast("date"), version * 365)
    rows = part.withColumn("version", F.explode(F.sequence(F.lit(0), (key % 3).cast("int")))).select(
        (key * 3 + version).alias("prd_id"),
        F.concat(_category_id("-"), F.lit("-"), _padded(key, 6)).alias("prd_key"),
        F.concat("p_name", F.lit(" "), (key % 50).cast("string")).alias("prd_nm"),
        F.when(key % 41 != 7, F.floor("p_retailprice") + version * 10).alias("prd_cost"),
        _by_remainder(F.col("p_size"), 6, {0: "R ", 1: "m ", 2: "S", 3: "T "}).alias("prd_line"),
        start.alias("prd_start_dt"),
        F.lit(None).alias("prd_end_dt"),
    )
    return _conform(rows, "crm_prd_info")


def raw_sales(read: Callable[[str], DataFrame]) -> DataFrame:
    """Order lines with missing, zero, negative and inconsistent amounts and dates.

    Merged, the lines of an order come together, as they are delivered, and compress
    well wherever they are shuffled or written next.
    """
    lines = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    key = F.col("l_orderkey")
    unit = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int")
    quantity = F.floor("l_quantity").cast("int")
    rows = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("SO"), key.cast("string")).alias("sls_ord_num"),
        F.when(key % 307 == 9, "ZZZZZZ")
        .otherwise(_padded(F.col("l_partkey"), 6))
        .alias("sls_prd_key"),
        F.col("o_custkey").alias("sls_cust_id"),
        _by_remainder(key, 211, {5: 0, 6: 32154}, _day_number(F.col("o_orderdate"))).alias(
            "sls_order_dt"
        ),
        _day_number(F.col("l_shipdate")).alias("sls_ship_dt"),
        _day_number(F.date_add(F.col("l_shipdate").cast("date"), 7)).alias("sls_due_dt"),
        _by_remainder(key, 103, {1: None, 2: -5, 3: 17}, quantity * unit).alias("sls_sales"),
        quantity.alias("sls_quantity"),
        _by_remainder(key, 101, {1: None, 2: -unit}, unit).alias("sls_price"),
    )
    return _conform(rows, "crm_sales_details")


def raw_erp_customers(read: Callable[[str], DataFrame]) -> DataFrame:
    """Birthdates and genders for most customers, a third with a prefixed id."""
    key = F.col("c_custkey")
    birthdate = F.date_add(F.lit("1940-01-01").cast("date"), (key * 7 % 20000).cast("int"))
    rows = (
        read("customer")
        .where(key % 20 != 7)
        .select(
            F.when(key % 3 == 0, F.concat(F.lit("NAS"), _customer_key()))
            .otherwise(_customer_key())
            .alias("cid"),
            _by_remainder(
                key, 50, {49: F.lit("2999-01-01").cast("date"), 48: None}, birthdate
            ).alias("bdate"),
            _by_remainder(key, 7, {0: "F", 1: " female", 2: "M", 3: "Male ", 4: ""}).alias("gen"),
        )
    )
    return _conform(rows, "erp_cust_az12")


def raw_locations(read: Callable[[str], DataFrame]) -> DataFrame:
    """Countries for most customers, some as codes, blank or missing."""
    key, nation = F.col("c_custkey"), F.col("n_nationkey")
    rows = (
        read("customer")
        .where(key % 30 != 11)
        .join(read("nation"), F.col("c_nationkey") == nation)
        .select(
            F.concat(F.lit("AW-"), _padded(key, 8)).alias("cid"),
            F.when(nation == 0, "DE")
            .when(nation == 1, "US")
            .when(nation == 2, "USA ")
            .when(nation == 3, "  ")
            .when(nation == 4, None)
            .otherwise(F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")))
            .alias("cntry"),
        )
    )
    return _conform(rows, "erp_loc_a101")


def raw_categories(read: Callable[[str], DataFrame]) -> DataFrame:
    """Categories of all brands but one, so that some products have none."""
    rows = (
        read("part")
        .where(F.col("p_brand") != "Brand#7")
        .select("p_type", "p_brand")
        .distinct()
        .select(
            _category_id("_").alias("id"),
            F.col("p_type").alias("cat"),
            F.concat("p_type", F.lit(" "), "p_brand").alias("subcat"),
            F.when(F.col("p_brand").contains("1"), "Yes").otherwise("No").alias("maintenance"),
        )
    )
    return _conform(rows, "erp_px_cat_g1v2")


RAW_TABLES = {
    "crm_cust_info": raw_customers,
    "crm_prd_info": raw_products,
    "crm_sales_details": raw_sales,
    "erp_loc_a101": raw_locations,
    "erp_cust_az12": raw_erp_customers,
    "erp_px_cat_g1v2": raw_categories,
}


SAMPLE_TABLES = ("customer", "lineitem", "nation", "orders", "part")


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six raw tables over the sample tables in ``folder``."""

    def read(table: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{table}.parquet")

    return {name: build(read) for name, build in RAW_TABLES.items()}


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a table the way the source systems deliver it: unquoted CSV, in compressed files.

    A compressed file is read by one task, so none has more than LINES_PER_FILE lines.
    """
    (
        df.write.option("header", True)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", LINES_PER_FILE)
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
