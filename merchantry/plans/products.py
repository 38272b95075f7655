"""Questions about the product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import int_avg
from ..operators import top_n


def product_hierarchy(products: DataFrame) -> DataFrame:
    """Every product below its category and subcategory.

    Name and key extend the order, so that one large subcategory can be cut
    into several sort ranges.
    """
    return products.orderBy("category", "subcategory", "product_name", "product_key").select(
        "category", "subcategory", "product_name"
    )


def products_by_category(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(F.count("product_key").alias("total_products"))
        .orderBy(F.desc("total_products"), "category")
    )


def products_by_subcategory(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category", "subcategory")
        .agg(F.count("product_key").alias("total_products"))
        .orderBy(F.desc("total_products"), "category", "subcategory")
    )


def avg_cost_by_category(products: DataFrame) -> DataFrame:
    """Mean cost per category, a truncated integer."""
    return (
        products.groupBy("category")
        .agg(int_avg(F.col("cost")).alias("average_cost"))
        .orderBy(F.desc("average_cost"), "category")
    )


def _top10_by_cost(products: DataFrame, cost_order) -> DataFrame:
    return top_n(products, [cost_order, "product_key"], 10).select(
        "product_name", "category", "subcategory", "cost"
    )


def top10_products_highest_cost(products: DataFrame) -> DataFrame:
    return _top10_by_cost(products, F.desc("cost"))


def top10_products_lowest_cost(products: DataFrame) -> DataFrame:
    return _top10_by_cost(products, F.asc("cost"))
