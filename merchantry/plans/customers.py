"""Questions about the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _customers_by(customers: DataFrame, column: str) -> DataFrame:
    counts = customers.groupBy(column).agg(F.count("customer_key").alias("total_customers"))
    return counts.orderBy(F.desc("total_customers"), column)


def customer_countries(customers: DataFrame) -> DataFrame:
    """Countries customers live in."""
    return customers.select("country").distinct()


def customers_by_country(customers: DataFrame) -> DataFrame:
    return _customers_by(customers, "country")


def customers_by_gender(customers: DataFrame) -> DataFrame:
    return _customers_by(customers, "gender")


def customers_by_marital_status(customers: DataFrame) -> DataFrame:
    return _customers_by(customers, "marital_status")


def customers_by_create_year(customers: DataFrame) -> DataFrame:
    """New customers per year."""
    return (
        customers.groupBy(F.year("create_date").alias("create_year"))
        .agg(F.count("customer_key").alias("total_customers"))
        .orderBy("create_year")
    )


def birthdate_range(customers: DataFrame) -> DataFrame:
    """Birthdates of the oldest and the youngest customer."""
    return customers.agg(
        F.min("birthdate").alias("oldest_birthdate"), F.max("birthdate").alias("youngest_birthdate")
    )
