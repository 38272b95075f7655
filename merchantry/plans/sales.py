"""Questions about the sales fact and its dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import concat_text, int_div, truncated_ratio, years_between
from ..operators import distinct_counts, roll_up, top_n
from ..schemas import GOLD

REVENUE = {"revenue": "sales_amount"}


def order_period(sales: DataFrame) -> DataFrame:
    """First and last order date, and the year boundaries between them."""
    first, last = F.min("order_date"), F.max("order_date")
    return sales.agg(
        first.alias("first_order"),
        last.alias("last_order"),
        years_between(first, last).alias("range_years"),
    )


def all_sales(sales: DataFrame) -> DataFrame:
    """The whole fact."""
    return sales.select(*GOLD["sales"].fieldNames())


def key_sales_metrics(sales: DataFrame) -> DataFrame:
    """Six measures of the whole fact from one scan; ``total_orders`` counts order lines."""
    found = distinct_counts(
        sales,
        {"total_products_sold": "product_key", "total_customers": "customer_key"},
        {
            "total_sold": F.col("quantity"),
            "total_sales": F.col("sales_amount"),
            "price": F.col("price"),
            "prices": F.col("price").isNotNull().cast("int"),
            "total_orders": F.col("order_number").isNotNull().cast("int"),
        },
    )
    return found.select(
        "total_sold",
        "total_sales",
        int_div(F.col("price"), F.nullif(F.col("prices"), F.lit(0))).alias("average_price"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "total_products_sold",
        "total_customers",
    )


def _revenue_by(
    sales: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    revenue = roll_up(sales, dimension, key, attributes, REVENUE)
    return revenue.orderBy(F.desc("revenue"), *attributes)


def revenue_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _revenue_by(sales, products, "product_key", ["category"])


def revenue_by_subcategory(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _revenue_by(sales, products, "product_key", ["category", "subcategory"])


def _customer_revenue(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per full name; sales without a customer come under a name of one space."""
    first_name, last_name = F.col("first_name"), F.col("last_name")
    name = concat_text(first_name, F.lit(" "), last_name).alias("customer_name")
    names = ["first_name", "last_name"]
    return roll_up(sales, customers, "customer_key", names, REVENUE, label=name)


def revenue_by_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return _customer_revenue(sales, customers).orderBy(F.desc("revenue"), "customer_name")


def top10_customers_by_revenue(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return top_n(_customer_revenue(sales, customers), [F.desc("revenue"), "customer_name"], 10)


def revenue_by_country(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return _revenue_by(sales, customers, "customer_key", ["country"])


def customers_and_revenue_by_country(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers who bought, and what they bought for, per country."""
    totals = roll_up(
        sales, customers, "customer_key", ["country"], REVENUE, members="total_customers"
    )
    return totals.select("country", "total_customers", "revenue").orderBy(
        F.desc("revenue"), "country"
    )


def revenue_by_gender(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return _revenue_by(sales, customers, "customer_key", ["gender"])


def revenue_by_marital_status(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return _revenue_by(sales, customers, "customer_key", ["marital_status"])


def product_revenue_quantity(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and units per product."""
    names = ["product_name", "category", "subcategory"]
    totals = roll_up(
        sales, products, "product_key", names, {**REVENUE, "quantity_sold": "quantity"}
    )
    return totals.orderBy(F.desc("revenue"), *names)


def _top10_products(sales: DataFrame, products: DataFrame, name: str, measure: str) -> DataFrame:
    names = ["product_name", "category"]
    totals = roll_up(sales, products, "product_key", names, {name: measure})
    return top_n(totals, [F.desc(name), *names], 10)


def top10_products_by_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _top10_products(sales, products, "revenue", "sales_amount")


def top10_products_by_quantity(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _top10_products(sales, products, "quantity_sold", "quantity")


def average_order_value(sales: DataFrame) -> DataFrame:
    """Revenue per order, a truncated integer."""
    return sales.agg(
        int_div(F.sum("sales_amount"), F.count_distinct("order_number")).alias(
            "average_order_value"
        )
    )


def average_quantity_per_order(sales: DataFrame) -> DataFrame:
    """Units per order with thirteen decimals, the rest cut off."""
    orders = F.nullif(F.count_distinct("order_number"), F.lit(0)).cast("decimal(20,0)")
    places = truncated_ratio(F.sum("quantity"), orders, 13)
    ratio = places.cast("decimal(20,0)") * F.lit(Decimal("0.0000000000001"))
    return sales.agg(ratio.cast("decimal(29,13)").alias("average_quantity_per_order"))
