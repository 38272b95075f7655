"""Cleaned layer: one function per table, and the full load."""

from __future__ import annotations

from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    COUNTRY,
    CRM_GENDER,
    ERP_CUSTOMER_PREFIX,
    ERP_GENDER,
    MARITAL_STATUS,
    PRODUCT_LINE,
    UNKNOWN,
)
from ..functions import EXACT, code_label, collated, decode_yyyymmdd, int_div, is_undecodable, text_length
from ..operators import following_value, latest_per_key
from ..schemas import AUDIT_COLUMN, SILVER
from ..sources.bronze import read_bronze
from ..session import scratch
from ..sources.tables import Release, publish, read_table


MOST_INT = 2**31 - 1


def _code(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Latest row of each customer id, names trimmed, codes spelled out."""
    latest = latest_per_key(bronze.where(F.col("cst_id").isNotNull()), "cst_id", "cst_create_date")
    return latest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        code_label(_code("cst_marital_status"), MARITAL_STATUS).alias("cst_marital_status"),
        code_label(_code("cst_gndr"), CRM_GENDER).alias("cst_gndr"),
        "cst_create_date",
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    """Category and product key split, and each version valid until the next starts.

    The delivered end date is not used. Versions follow each other within the
    whole source key, category prefix included.
    """
    versions = following_value(
        bronze.drop("prd_end_dt"),
        "prd_key",
        ["prd_start_dt", "prd_id"],
        "prd_start_dt",
        "next_start_dt",
    )
    key = F.col("prd_key")
    return versions.select(
        "prd_id",
        F.replace(F.substring(key, 1, 5), F.lit("-"), F.lit("_")).alias("cat_id"),
        F.substring(key, F.lit(7), text_length(key)).alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        code_label(_code("prd_line"), PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        F.date_sub(F.col("next_start_dt").cast("date"), 1).alias("prd_end_dt"),
    )


def _line_amount() -> Column:
    """Quantity times price without its sign, in full."""
    return F.col("sls_quantity").cast("long") * F.abs(F.col("sls_price").cast("long"))


def silver_sales(bronze: DataFrame) -> DataFrame:
    """Dates decoded, amounts and prices repaired.

    Both repairs read the delivered values, neither sees the other's result. A
    repaired amount beyond the range of its column is NULL, like a date that is
    none.
    """
    sales, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    product = _line_amount()
    expected = F.when(product <= MOST_INT, product).cast("int")
    bad_sales = sales.isNull() | (sales <= 0) | (sales != product)
    bad_price = price.isNull() | (price <= 0)
    derived_price = int_div(sales, F.nullif(quantity, F.lit(0))).cast("int")
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        decode_yyyymmdd(F.col("sls_order_dt")).alias("sls_order_dt"),
        decode_yyyymmdd(F.col("sls_ship_dt")).alias("sls_ship_dt"),
        decode_yyyymmdd(F.col("sls_due_dt")).alias("sls_due_dt"),
        F.when(bad_sales, expected).otherwise(sales).alias("sls_sales"),
        "sls_quantity",
        F.when(bad_price, derived_price).otherwise(price).alias("sls_price"),
    )


def silver_erp_customers(bronze: DataFrame, as_of: date | datetime | None = None) -> DataFrame:
    """Id prefix removed, birthdates after ``as_of`` (default: now) dropped, gender spelled out."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    cid, birthdate = F.col("cid"), F.col("bdate")
    without_prefix = F.substring(cid, F.lit(len(ERP_CUSTOMER_PREFIX) + 1), text_length(cid))
    return bronze.select(
        F.when(cid.startswith(ERP_CUSTOMER_PREFIX), without_prefix).otherwise(cid).alias("cid"),
        F.when(birthdate.cast("timestamp") > now, None).otherwise(birthdate).alias("bdate"),
        code_label(_code("gen"), ERP_GENDER).alias("gen"),
    )


def silver_locations(bronze: DataFrame) -> DataFrame:
    """Dashes removed from the id, countries spelled out."""
    country = F.trim("cntry")
    return bronze.select(
        F.replace("cid", F.lit("-"), F.lit("")).alias("cid"),
        F.when(country.isNull() | (country == ""), UNKNOWN)
        .otherwise(code_label(country, COUNTRY, otherwise=country))
        .alias("cntry"),
    )


def silver_categories(bronze: DataFrame) -> DataFrame:
    """Categories as they are."""
    return bronze.select("id", "cat", "subcat", "maintenance")


def with_audit(df: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """``df`` with its load time (default: now)."""
    # A time without zone is one of the session's zone.
    stamp = F.current_timestamp() if load_ts is None else F.lit(str(load_ts)).cast("timestamp")
    return df.withColumn(AUDIT_COLUMN, stamp)


def load_silver(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    as_of: date | datetime | None = None,
    load_ts: datetime | None = None,
    collation: str | None = None,
) -> dict[str, int]:
    """Full refresh of the six cleaned tables, written side by side and released at once.

    Strings are compared under ``collation`` (default: by exact characters); the
    stored columns are plain strings.

    An error is raised and ends the load; the six tables are the old ones then.
    Returns the number of values that looked like dates and were none, by sales
    column, and under ``sls_sales`` that of repaired amounts beyond its range.
    """

    def bronze(table: str) -> DataFrame:
        return collated(read_bronze(spark, bronze_dir, table), collation)

    rejected = Observation()
    dates = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]

    def sales() -> DataFrame:
        raw = bronze("crm_sales_details").observe(
            rejected,
            *[F.count_if(is_undecodable(F.col(c))).alias(c) for c in dates],
            F.count_if(_line_amount() > MOST_INT).alias("sls_sales"),
        )
        return silver_sales(raw)

    cleaned = {
        "crm_cust_info": lambda: silver_customers(bronze("crm_cust_info")),
        "crm_prd_info": lambda: silver_products(bronze("crm_prd_info")),
        "crm_sales_details": sales,
        "erp_cust_az12": lambda: silver_erp_customers(bronze("erp_cust_az12"), as_of),
        "erp_loc_a101": lambda: silver_locations(bronze("erp_loc_a101")),
        "erp_px_cat_g1v2": lambda: silver_categories(bronze("erp_px_cat_g1v2")),
    }

    def stamped(table: str) -> DataFrame:
        df = collated(cleaned[table](), collation and EXACT)
        return with_audit(df, load_ts).select(*SILVER[table].fieldNames())

    with Release(spark, silver_dir) as release, scratch(spark):
        release.write_all({table: partial(stamped, table) for table in cleaned})
        release.publish()
    return {c: rejected.get[c] for c in (*dates, "sls_sales")}


def publish_silver(spark: SparkSession, silver_dir: str) -> None:
    """Make the cleaned tables known to SQL as ``silver.<table>``.

    Rows that are inserted without a load time get the time of their insertion.
    """
    publish(spark, "silver", silver_dir, SILVER, {AUDIT_COLUMN: "current_timestamp()"})


def read_silver(spark: SparkSession, silver_dir: str, table: str) -> DataFrame:
    """Scan of a cleaned table."""
    return read_table(spark, f"{silver_dir}/{table}", SILVER[table])
