"""Sales over time.

Lines without an order date form a group of their own, with a NULL year that
sorts first. Yearly results have at most one row per calendar year, so the
windows over them are small whatever the fact holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import growth_percentage, int_div
from ..operators import distinct_counts, roll_up, top_n_per_group
from .gold import YEAR
from .sales import REVENUE


def order_year(sales: DataFrame) -> Column:
    """Year of an order line; a fact that is laid out by year has it as a column."""
    known = YEAR in sales.columns
    return F.col(YEAR) if known else F.year("order_date").alias(YEAR)


def dated_lines(sales: DataFrame) -> DataFrame:
    """Order lines with a date; where the fact is laid out by year, others are not read."""
    return sales.where(F.col(YEAR if YEAR in sales.columns else "order_date").isNotNull())


def _per_year(sales: DataFrame, measure: Column) -> DataFrame:
    return sales.groupBy(order_year(sales)).agg(measure).orderBy(YEAR)


def yearly_revenue(sales: DataFrame) -> DataFrame:
    return _per_year(sales, F.sum("sales_amount").alias("revenue"))


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(order_year(sales), F.month("order_date").alias("order_month"))
        .agg(F.sum("sales_amount").alias("revenue"))
        .orderBy("order_year", "order_month")
    )


def yearly_orders(sales: DataFrame) -> DataFrame:
    return _per_year(sales, F.count_distinct("order_number").alias("total_orders"))


def yearly_quantity(sales: DataFrame) -> DataFrame:
    return _per_year(sales, F.sum("quantity").alias("total_quantity"))


def yearly_active_customers(sales: DataFrame) -> DataFrame:
    by_year = sales.withColumn(YEAR, order_year(sales))
    return distinct_counts(by_year, {"active_customers": "customer_key"}, by=[YEAR]).orderBy(YEAR)


def yearly_average_order_value(sales: DataFrame) -> DataFrame:
    """Revenue per order, a truncated integer, per year."""
    ratio = int_div(F.sum("sales_amount"), F.count_distinct("order_number"))
    return _per_year(sales, ratio.alias("average_order_value"))


def _yearly_revenue_by(
    sales: DataFrame, dimension: DataFrame, key: str, attribute: str
) -> DataFrame:
    by_year = sales.withColumn(YEAR, order_year(sales))
    return roll_up(by_year, dimension, key, [attribute], REVENUE, by=["order_year"])


def yearly_category_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    revenue = _yearly_revenue_by(sales, products, "product_key", "category")
    return revenue.orderBy("order_year", F.desc("revenue"), "category")


def yearly_country_revenue(sales: DataFrame, customers: DataFrame) -> DataFrame:
    revenue = _yearly_revenue_by(sales, customers, "customer_key", "country")
    return revenue.orderBy("order_year", F.desc("revenue"), "country")


def yearly_product_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per year and product name."""
    return _yearly_revenue_by(sales, products, "product_key", "product_name")


def top10_products_per_year(sales: DataFrame, products: DataFrame) -> DataFrame:
    """The ten products of each year with the highest revenue."""
    ranked = top_n_per_group(
        yearly_product_revenue(sales, products),
        ["order_year"],
        [F.desc("revenue"), "product_name"],
        10,
        "product_rank",
    )
    return ranked.select("order_year", "product_name", "revenue", "product_rank").orderBy(
        "order_year", "product_rank"
    )


def yearly_revenue_growth(sales: DataFrame) -> DataFrame:
    """Change against the previous year that has sales; the undated year counts as the first."""
    yearly = sales.groupBy(order_year(sales)).agg(F.sum("sales_amount").alias("revenue"))
    previous = F.lag("revenue").over(W.orderBy("order_year"))
    revenue, before = F.col("revenue"), F.col("previous_revenue")
    return (
        yearly.withColumn("previous_revenue", previous)
        .select(
            "order_year",
            "revenue",
            "previous_revenue",
            (revenue - before).alias("revenue_change"),
            growth_percentage(revenue, before).alias("revenue_growth_percentage"),
        )
        .orderBy("order_year")
    )
