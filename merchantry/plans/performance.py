"""Running totals, and products against their own history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed_values import (
    ABOVE_AVERAGE,
    BELOW_AVERAGE,
    DECREASE,
    INCREASE,
    NO_CHANGE,
    ON_AVERAGE,
)
from ..functions import growth_percentage, int_avg
from .trends import dated_lines, yearly_product_revenue


def running_total_revenue(sales: DataFrame) -> DataFrame:
    """Yearly revenue summed up over the years, and the mean of the yearly mean prices."""
    yearly = (
        dated_lines(sales)
        .groupBy(F.trunc("order_date", "year").alias("order_date"))
        .agg(F.sum("sales_amount").alias("revenue"), int_avg(F.col("price")).alias("avg_price"))
    )
    # At most one row per calendar year, so one task holds them all.
    so_far = W.orderBy("order_date")
    return yearly.select(
        "order_date",
        "revenue",
        F.sum("revenue").over(so_far).alias("running_total_revenue"),
        int_avg(F.col("avg_price"), so_far).alias("cumulative_average_price"),
    )


def _sign_label(difference: Column, positive: str, negative: str, neither: str) -> Column:
    return F.when(difference > 0, positive).when(difference < 0, negative).otherwise(neither)


def product_yoy_performance(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Each product's year against its own average and its previous year with sales.

    The windows run over one row per product and calendar year.
    """
    yearly = yearly_product_revenue(dated_lines(sales), products).withColumnRenamed("revenue", "current_sales")
    history = W.partitionBy("product_name")
    current = F.col("current_sales")
    compared = (
        yearly.withColumn("previous_year_sales", F.lag(current).over(history.orderBy("order_year")))
        .withColumn("avg_sales", int_avg(current, history))
        .withColumn("diff_avg", current - F.col("avg_sales"))
        .withColumn("diff_previous_year", current - F.col("previous_year_sales"))
    )
    return compared.select(
        "order_year",
        "product_name",
        "current_sales",
        "avg_sales",
        "diff_avg",
        _sign_label(F.col("diff_avg"), ABOVE_AVERAGE, BELOW_AVERAGE, ON_AVERAGE).alias(
            "avg_change"
        ),
        "previous_year_sales",
        "diff_previous_year",
        growth_percentage(current, F.col("previous_year_sales")).alias("yoy_growth_percentage"),
        _sign_label(F.col("diff_previous_year"), INCREASE, DECREASE, NO_CHANGE).alias("yoy_change"),
    ).orderBy("product_name", "order_year")
