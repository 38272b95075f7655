"""Every question and table by name, as a function of a session and a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import SERVER_COLLATION, collated
from ..operators import column_profile, surrogate_key, table_profile
from ..schemas import AUDIT_COLUMN, BRONZE, GOLD, SILVER
from ..session import store, workspace
from ..sources.bronze import (
    SOURCE_FILES,
    load_bronze,
    load_raw_table,
    read_bronze,
    read_rejects,
)
from ..sources.sample_data import SAMPLE_TABLES, write_raw_csv
from ..sources.tables import delete, exists, state
from . import collation, customers, performance, products, sales, trends
from .gold import load_gold, read_gold
from .silver import load_silver, read_silver
from .warehouse import TABLE_NAMES, Warehouse, open_warehouse

Query = Callable[[SparkSession, str], DataFrame]

# The load time of whatever the queries load.
LOAD_TIME = datetime(2025, 1, 1, 6, 30)

# Birthdates after this day count as future ones, whenever the queries run.
AS_OF = date(2025, 1, 1)

CUSTOMERS, PRODUCTS, SALES = "gold.customers", "gold.products", "gold.sales"

# Question, and the tables it takes as arguments.
REPORTS: dict[Callable[..., DataFrame], tuple[str, ...]] = {
    customers.customer_countries: (CUSTOMERS,),
    customers.customers_by_country: (CUSTOMERS,),
    customers.customers_by_gender: (CUSTOMERS,),
    customers.customers_by_marital_status: (CUSTOMERS,),
    customers.customers_by_create_year: (CUSTOMERS,),
    customers.birthdate_range: (CUSTOMERS,),
    products.product_hierarchy: (PRODUCTS,),
    products.products_by_category: (PRODUCTS,),
    products.products_by_subcategory: (PRODUCTS,),
    products.avg_cost_by_category: (PRODUCTS,),
    products.top10_products_highest_cost: (PRODUCTS,),
    products.top10_products_lowest_cost: (PRODUCTS,),
    sales.order_period: (SALES,),
    sales.all_sales: (SALES,),
    sales.key_sales_metrics: (SALES,),
    sales.revenue_by_category: (SALES, PRODUCTS),
    sales.revenue_by_subcategory: (SALES, PRODUCTS),
    sales.revenue_by_customer: (SALES, CUSTOMERS),
    sales.top10_customers_by_revenue: (SALES, CUSTOMERS),
    sales.revenue_by_country: (SALES, CUSTOMERS),
    sales.customers_and_revenue_by_country: (SALES, CUSTOMERS),
    sales.product_revenue_quantity: (SALES, PRODUCTS),
    sales.top10_products_by_revenue: (SALES, PRODUCTS),
    sales.top10_products_by_quantity: (SALES, PRODUCTS),
    trends.yearly_revenue: (SALES,),
    trends.monthly_revenue: (SALES,),
    trends.yearly_orders: (SALES,),
    sales.average_order_value: (SALES,),
    sales.average_quantity_per_order: (SALES,),
    sales.revenue_by_gender: (SALES, CUSTOMERS),
    sales.revenue_by_marital_status: (SALES, CUSTOMERS),
    trends.yearly_quantity: (SALES,),
    trends.yearly_active_customers: (SALES,),
    trends.yearly_average_order_value: (SALES,),
    trends.yearly_category_revenue: (SALES, PRODUCTS),
    trends.top10_products_per_year: (SALES, PRODUCTS),
    trends.yearly_country_revenue: (SALES, CUSTOMERS),
    trends.yearly_revenue_growth: (SALES,),
    performance.running_total_revenue: (SALES,),
    performance.product_yoy_performance: (SALES, PRODUCTS),
}


def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return open_warehouse(spark, folder, AS_OF)


def _report(function: Callable[..., DataFrame], tables: tuple[str, ...]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        warehouse = _warehouse(spark, folder)
        if function is sales.order_period:
            return function(warehouse.dated_footers())
        return function(*[warehouse.fact() if t == SALES else warehouse.table(t) for t in tables])

    return query


def _table(name: str) -> Query:
    return lambda spark, folder: _warehouse(spark, folder).table(name)


def _copied(df: DataFrame, run: str) -> DataFrame:
    """``df`` stored by itself, after which the folder it was read from is removed."""
    kept = store(df, "result")
    delete(df.sparkSession, run)
    return kept


def _from_csv(table: str) -> Query:
    """The raw table after a trip through a delivered file and the bulk load."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        run = f"{workspace(spark)}/csv-{uuid.uuid4().hex}"
        write_raw_csv(_warehouse(spark, folder).table(f"bronze.{table}"), f"{run}/{table}.csv")
        load_raw_table(spark, f"{run}/{table}.csv", f"{run}/{table}", BRONZE[table])
        return _copied(read_bronze(spark, run, table), run)

    return query


def csv_rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines a load turns away when some order lines carry a word as their quantity."""
    table, spoiled = "crm_sales_details", 13
    run = f"{workspace(spark)}/csv-{uuid.uuid4().hex}"
    lines = _warehouse(spark, folder).table(f"bronze.{table}")
    quantity = F.col("sls_quantity")
    write_raw_csv(
        lines.withColumn(
            "sls_quantity", F.when(quantity == spoiled, "many").otherwise(quantity.cast("string"))
        ),
        f"{run}/{table}.csv",
    )
    load_raw_table(spark, f"{run}/{table}.csv", f"{run}/{table}", BRONZE[table])
    # Files are delivered in folders, whose names do not change from run to run.
    delivered = F.regexp_extract("bad_file", r"/([^/]+\.csv)(/|$)", 1).alias("delivered_file")
    return _copied(read_rejects(spark, run, table).select(delivered, "bad_line"), run)


_loads: dict[tuple, str] = {}


def _loaded(spark: SparkSession, folder: str) -> str:
    """Root of the layers loaded from delivered files, once per application and sample tables."""
    files = tuple(state(spark, f"{folder}/{name}.parquet") for name in SAMPLE_TABLES)
    key = (spark.sparkContext.applicationId, folder, files)
    if key in _loads and exists(spark, _loads[key]):
        return _loads[key]
    run = f"{workspace(spark)}/load-{uuid.uuid4().hex}"
    for table, file in SOURCE_FILES.items():
        write_raw_csv(_warehouse(spark, folder).table(f"bronze.{table}"), f"{run}/delivered/{file}")
    load_bronze(spark, f"{run}/delivered", f"{run}/bronze")
    load_silver(spark, f"{run}/bronze", f"{run}/silver", AS_OF, LOAD_TIME)
    load_gold(spark, f"{run}/silver", f"{run}/gold")
    _loads[key] = run
    return run


def _loaded_table(layer: str, table: str) -> Query:
    """Contents of a table as the loads left it."""
    read = {"silver": read_silver, "gold": read_gold}[layer]
    return lambda spark, folder: read(spark, f"{_loaded(spark, folder)}/{layer}", table).drop(
        AUDIT_COLUMN
    )


def silver_load_times(spark: SparkSession, folder: str) -> DataFrame:
    """Load times in the audit column of the stored cleaned tables, and their rows."""
    run = _loaded(spark, folder)
    times = [
        read_silver(spark, f"{run}/silver", table)
        .groupBy(F.lit(table).alias("table_name"), F.col(AUDIT_COLUMN).cast("timestamp_ntz"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .toDF("table_name", AUDIT_COLUMN, "n_rows")
        for table in SILVER
    ]
    return reduce(DataFrame.unionByName, times)


def full_load(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way, from delivered files to the star schema; profile of the stored tables."""
    run = _loaded(spark, folder)
    return table_profile(
        {
            **{f"bronze.{t}": read_bronze(spark, f"{run}/bronze", t) for t in BRONZE},
            **{f"silver.{t}": read_silver(spark, f"{run}/silver", t) for t in SILVER},
            **{f"gold.{t}": read_gold(spark, f"{run}/gold", t) for t in GOLD},
        }
    )


def product_version_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Dense numbers of all product versions by start date and product key."""
    versions = _warehouse(spark, folder).table("silver.crm_prd_info")
    return surrogate_key(
        versions.select("prd_start_dt", "prd_key", "prd_id"),
        ["prd_start_dt", "prd_key", "prd_id"],
        "version_key",
    )


_respelt: dict[Warehouse, Warehouse] = {}


def _respelt_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse whose keys and names are spelt in several ways, under the server's collation."""
    exact = _warehouse(spark, folder)
    if exact not in _respelt:
        cleaned = {t: collation.respelt(exact.table(f"silver.{t}"), t) for t in SILVER}
        _respelt[exact] = Warehouse({}, AS_OF, SERVER_COLLATION, cleaned)
    return _respelt[exact]


def collated_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by country and category where both, and the keys, are spelt in several ways."""
    warehouse = _respelt_warehouse(spark, folder)
    return collation.revenue_by_country_and_category(
        *[warehouse.table(t) for t in (SALES, PRODUCTS, CUSTOMERS)]
    )


def collated_product_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of products whose keys are spelt in several ways, each until the next starts."""
    raw = collation.respelt(_warehouse(spark, folder).table("bronze.crm_prd_info"), "crm_prd_info")
    return collation.product_versions(collated(raw, SERVER_COLLATION))


def _profile(
    function: Callable[..., DataFrame], form: Callable[[Warehouse, str], DataFrame]
) -> Query:
    """A profile of all tables of the three layers."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        warehouse = _warehouse(spark, folder)
        return function({name: form(warehouse, name) for name in TABLE_NAMES})

    return query


def all_queries() -> dict[str, Query]:
    """Registered queries by name."""
    named = {name.replace(".", "_"): _table(name) for name in TABLE_NAMES}
    named.update({f"csv_{table}": _from_csv(table) for table in BRONZE})
    named["csv_rejected_lines"] = csv_rejected_lines
    named["full_load"] = full_load
    named["silver_load_times"] = silver_load_times
    for layer, tables in (("silver", SILVER), ("gold", GOLD)):
        named.update({f"loaded_{layer}_{t}": _loaded_table(layer, t) for t in tables})
    named["surrogate_key"] = product_version_keys
    named["collated_revenue"] = collated_revenue
    named["collated_product_versions"] = collated_product_versions
    named["table_profile"] = _profile(table_profile, Warehouse.footers)
    named["column_profile"] = _profile(column_profile, Warehouse.stored)
    named.update({f.__name__: _report(f, tables) for f, tables in REPORTS.items()})
    return named
