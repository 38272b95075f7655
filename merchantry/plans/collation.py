"""Questions over keys and names that differ in case and trailing blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import EXACT
from ..operators import left_lookup
from ..session import store
from .silver import silver_products

# Columns that are spelt in several ways, and what decides on the spelling of a row.
SPELT_BY = {
    "crm_sales_details": {"sls_prd_key": "sls_quantity"},
    "crm_prd_info": {"prd_key": "prd_id"},
    "erp_loc_a101": {"cid": "ascii(right(cid, 1))", "cntry": "ascii(right(cid, 1)) + 1"},
    "erp_px_cat_g1v2": {"id": "ascii(right(id, 1))", "cat": "length(subcat)"},
}
# Cleaned products are looked up by their key, so that their category is spelt anew instead.
SPELT_BY_CLEANED = SPELT_BY | {"crm_prd_info": {"cat_id": "prd_id"}}


def respelt(df: DataFrame, table: str) -> DataFrame:
    """``df`` with keys and names in lower case, with blanks after them, or as they are."""
    cleaned = "cat_id" in df.columns
    return df.withColumns(
        {
            c: F.when(F.expr(f"({by}) % 3") == 0, F.lower(c))
            .when(F.expr(f"({by}) % 3") == 1, F.concat(F.col(c), F.lit("  ")))
            .otherwise(F.col(c))
            for c, by in (SPELT_BY_CLEANED if cleaned else SPELT_BY).get(table, {}).items()
        }
    )


def _label(name: str):
    """One spelling for all: groups under a collation show that of any row."""
    return F.lower(F.rtrim(F.collate(F.col(name), EXACT))).alias(name)


def _with_labels(dimension: DataFrame, *columns: str) -> DataFrame:
    """``dimension`` with one exact label for all that is alike under the collation of a column.

    Spellings are grouped exactly first, so only distinct ones are compared under
    the collation, and whoever groups by the labels compares bytes.
    """
    for column in columns:
        collation = dimension.schema[column].dataType.collation
        spellings = dimension.select(F.collate(F.col(column), EXACT).alias("_spelling")).distinct()
        alike = W.partitionBy(F.collate(F.col("_spelling"), collation))
        label = F.min(F.lower(F.rtrim("_spelling"))).over(alike).alias("_label")
        dimension = (
            dimension.withColumn(column, F.collate(F.col(column), EXACT))
            .join(spellings.select("_spelling", label), F.col(column) == F.col("_spelling"), "left")
            .withColumn(column, F.col("_label"))
            .drop("_spelling", "_label")
        )
    return dimension


def revenue_by_country_and_category(
    sales: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Lines, revenue and products by country and category, compared under their collation.

    The dimensions, not the lines, are compared under it.
    """
    per_key = sales.groupBy("product_key", "customer_key").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("sales_amount").alias("revenue")
    )
    product_names = products.select(
        F.col("product_key").alias("_product"), "product_number", "category"
    )
    customer_names = customers.select(F.col("customer_key").alias("_customer"), "country")
    named = left_lookup(
        left_lookup(
            per_key,
            store(_with_labels(product_names, "product_number", "category"), "product-labels"),
            "product_key",
            "_product",
        ),
        store(_with_labels(customer_names, "country"), "customer-labels"),
        "customer_key",
        "_customer",
    )
    found = named.groupBy("country", "category").agg(
        F.sum("n_lines").alias("n_lines"),
        F.sum("revenue").alias("revenue"),
        F.count_distinct("product_number").alias("n_products"),
    )
    return found.select("country", "category", "n_lines", "revenue", "n_products")


def product_versions(raw: DataFrame) -> DataFrame:
    """Versions by product key, whatever its spelling, each until the next starts."""
    found = silver_products(raw)
    return found.select("prd_id", _label("prd_key"), "prd_start_dt", "prd_end_dt")
