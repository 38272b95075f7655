from datetime import date
from decimal import Decimal

import pytest
from helpers import gold_rows, plan_of, rows_of

from merchantry.plans import customers, performance, products, sales, trends


@pytest.fixture(scope="module")
def people(spark):
    return gold_rows(
        spark,
        "customers",
        {"customer_key": 1, "first_name": "Ann", "last_name": "Lee", "country": "France",
         "gender": "Female", "marital_status": "Single", "birthdate": date(1970, 1, 1),
         "create_date": date(2020, 3, 1)},
        {"customer_key": 2, "first_name": "Ann", "last_name": "Lee", "country": "France",
         "gender": "Female", "marital_status": "Married", "create_date": date(2021, 3, 1)},
        {"customer_key": 3, "first_name": "Bo", "country": "n/a", "gender": "Male",
         "marital_status": "Single", "birthdate": date(1990, 1, 1)},
    )


@pytest.fixture(scope="module")
def goods(spark):
    rows = [
        {"product_key": i, "product_name": f"P{i}", "category": "Bikes" if i % 2 else None,
         "subcategory": f"S{i % 3}", "cost": c}
        for i, c in enumerate([5, 5, 9, 1, 1, 1, 1, 1, 1, 1, 1, 1], start=1)
    ]
    return gold_rows(spark, "products", *rows)


@pytest.fixture(scope="module")
def fact(spark):
    def line(number, product, customer, day, amount, quantity, price):
        return {"order_number": number, "product_key": product, "customer_key": customer,
                "order_date": day, "sales_amount": amount, "quantity": quantity, "price": price}

    return gold_rows(
        spark,
        "sales",
        line("SO1", 1, 1, date(2019, 12, 31), 10, 1, 10),
        line("SO1", 2, 1, date(2019, 12, 31), 11, 1, 11),
        line("SO2", 1, 2, date(2021, 1, 1), 11, 2, 5),
        line("SO3", 1, 3, date(2021, 6, 1), 0, 1, None),
        line("SO4", None, None, None, 7, 3, 2),
        line("SO5", 2, 3, date(2022, 1, 1), None, None, 8),
    )


def test_customer_questions(people):
    assert sorted(rows_of(customers.customer_countries(people))) == [("France",), ("n/a",)]
    assert rows_of(customers.customers_by_country(people)) == [("France", 2), ("n/a", 1)]
    assert rows_of(customers.customers_by_gender(people)) == [("Female", 2), ("Male", 1)]
    assert rows_of(customers.customers_by_marital_status(people)) == [("Single", 2), ("Married", 1)]
    assert rows_of(customers.customers_by_create_year(people)) == [(None, 1), (2020, 1), (2021, 1)]
    assert rows_of(customers.birthdate_range(people)) == [(date(1970, 1, 1), date(1990, 1, 1))]


def test_product_questions(goods):
    assert rows_of(products.products_by_category(goods)) == [(None, 6), ("Bikes", 6)]
    assert rows_of(products.avg_cost_by_category(goods)) == [("Bikes", 3), (None, 1)]
    names = [r.product_name for r in products.product_hierarchy(goods).collect()]
    assert names[:6] == ["P12", "P6", "P10", "P4", "P2", "P8"]
    assert rows_of(products.products_by_subcategory(goods))[0] == (None, "S0", 2)


def test_ties_in_top_ten_lists_fall_by_key(goods):
    dearest = rows_of(products.top10_products_highest_cost(goods))
    assert [r[0] for r in dearest] == ["P3", "P1", "P2", "P4", "P5", "P6", "P7", "P8", "P9", "P10"]
    cheapest = rows_of(products.top10_products_lowest_cost(goods))
    assert [r[0] for r in cheapest] == [f"P{i}" for i in range(4, 13)] + ["P1"]


def test_order_period_counts_year_boundaries(fact):
    assert rows_of(sales.order_period(fact)) == [(date(2019, 12, 31), date(2022, 1, 1), 3)]


def test_key_metrics_count_lines_and_distinct_keys(fact, spark):
    found = sales.key_sales_metrics(fact).first().asDict()
    assert found == {
        "total_sold": 8, "total_sales": 39, "average_price": 7, "total_orders": 6,
        "total_products_sold": 2, "total_customers": 3,
    }
    empty = sales.key_sales_metrics(fact.where("false")).first().asDict()
    assert empty["total_orders"] == 0 and empty["total_sales"] is None


def test_unmatched_lines_keep_their_revenue(fact, goods, people):
    assert rows_of(sales.revenue_by_category(fact, goods)) == [("Bikes", 21), (None, 18)]
    assert rows_of(sales.revenue_by_country(fact, people)) == [
        ("France", 32), (None, 7), ("n/a", 0)
    ]
    assert rows_of(sales.customers_and_revenue_by_country(fact, people)) == [
        ("France", 2, 32), (None, 0, 7), ("n/a", 1, 0)
    ]


def test_customer_names_with_missing_parts(fact, people):
    found = rows_of(sales.revenue_by_customer(fact, people))
    assert found == [("Ann Lee", 32), (" ", 7), ("Bo ", 0)]
    assert rows_of(sales.top10_customers_by_revenue(fact, people)) == found


def test_product_totals(fact, goods):
    assert rows_of(sales.product_revenue_quantity(fact, goods)) == [
        ("P1", "Bikes", "S1", 21, 4), ("P2", None, "S2", 11, 1), (None, None, None, 7, 3)
    ]
    assert rows_of(sales.top10_products_by_quantity(fact, goods))[0] == ("P1", "Bikes", 4)
    assert rows_of(sales.top10_products_by_revenue(fact, goods))[0] == ("P1", "Bikes", 21)


def test_ratios_per_order(fact):
    assert rows_of(sales.average_order_value(fact)) == [(7,)]
    ratio = sales.average_quantity_per_order(fact)
    assert ratio.dtypes == [("average_quantity_per_order", "decimal(29,13)")]
    assert rows_of(ratio) == [(Decimal("1.6000000000000"),)]


def test_every_breakdown_adds_up(fact, goods, people):
    total = 39
    for df in (
        sales.revenue_by_subcategory(fact, goods), sales.revenue_by_gender(fact, people),
        sales.revenue_by_marital_status(fact, people), trends.yearly_revenue(fact),
        trends.monthly_revenue(fact), trends.yearly_category_revenue(fact, goods),
        trends.yearly_country_revenue(fact, people), trends.top10_products_per_year(fact, goods),
    ):
        assert sum(r.revenue or 0 for r in df.collect()) == total


def test_undated_lines_are_a_year_of_their_own(fact):
    assert rows_of(trends.yearly_revenue(fact)) == [(None, 7), (2019, 21), (2021, 11), (2022, None)]
    assert rows_of(trends.monthly_revenue(fact))[:2] == [(None, None, 7), (2019, 12, 21)]
    assert rows_of(trends.yearly_orders(fact)) == [(None, 1), (2019, 1), (2021, 2), (2022, 1)]
    assert rows_of(trends.yearly_quantity(fact)) == [(None, 3), (2019, 2), (2021, 3), (2022, None)]
    assert rows_of(trends.yearly_active_customers(fact)) == [
        (None, 0), (2019, 1), (2021, 2), (2022, 1)
    ]
    assert rows_of(trends.yearly_average_order_value(fact)) == [
        (None, 7), (2019, 21), (2021, 5), (2022, None)
    ]


def test_growth_compares_with_the_previous_available_year(fact):
    assert rows_of(trends.yearly_revenue_growth(fact)) == [
        (None, 7, None, None, None),
        (2019, 21, 7, 14, Decimal("200.00")),
        (2021, 11, 21, -10, Decimal("-47.62")),
        (2022, None, 11, None, None),
    ]


def test_yearly_ranks(fact, goods):
    assert rows_of(trends.top10_products_per_year(fact, goods)) == [
        (None, None, 7, 1), (2019, "P2", 11, 1), (2019, "P1", 10, 2), (2021, "P1", 11, 1),
        (2022, "P2", None, 1),
    ]
    assert rows_of(trends.yearly_category_revenue(fact, goods))[1:3] == [
        (2019, None, 11), (2019, "Bikes", 10)
    ]


def test_running_totals_average_the_yearly_averages(fact):
    # Yearly mean prices: 10 (of 10, 11), 5 (of 5, NULL) and 8.
    assert rows_of(performance.running_total_revenue(fact)) == [
        (date(2019, 1, 1), 21, 21, 10),
        (date(2021, 1, 1), 11, 32, 7),
        (date(2022, 1, 1), None, 32, 7),
    ]


def test_products_against_their_own_history(fact, goods):
    found = performance.product_yoy_performance(fact, goods)
    assert rows_of(found) == [
        # The mean of 10 and 11 is 10, so the first year is an average one.
        (2019, "P1", 10, 10, 0, "Avg", None, None, None, "No Change"),
        (2021, "P1", 11, 10, 1, "Above Avg", 10, 1, Decimal("10.00"), "Increase"),
        (2019, "P2", 11, 11, 0, "Avg", None, None, None, "No Change"),
        (2022, "P2", None, 11, None, "Avg", 11, None, None, "No Change"),
    ]


def test_falling_sales_get_their_labels(spark, goods):
    fact = gold_rows(
        spark,
        "sales",
        {"product_key": 1, "order_date": date(2020, 1, 1), "sales_amount": 30},
        {"product_key": 1, "order_date": date(2021, 1, 1), "sales_amount": 10},
        {"product_key": 1, "order_date": date(2022, 1, 1), "sales_amount": 10},
        {"product_key": 1, "order_date": date(2023, 1, 1), "sales_amount": 0},
        {"product_key": 1, "order_date": date(2024, 1, 1), "sales_amount": 5},
    )
    found = performance.product_yoy_performance(fact, goods).collect()
    assert [r.avg_change for r in found] == ["Above Avg"] + ["Below Avg"] * 4
    assert [r.yoy_change for r in found] == [
        "No Change", "Decrease", "No Change", "Decrease", "Increase"
    ]
    # No percentage against a year of zero sales.
    assert found[-1].yoy_growth_percentage is None and found[-1].diff_previous_year == 5


def test_filters_and_columns_reach_the_scan(spark, fact, goods, tmp_path):
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    plan = plan_of(performance.product_yoy_performance(stored, goods))
    assert "PushedFilters: [IsNotNull(order_date)]" in plan
    assert "ReadSchema: struct<product_key:bigint,order_date:date,sales_amount:int>" in plan
    yearly = plan_of(trends.yearly_revenue(stored))
    assert "ReadSchema: struct<order_date:date,sales_amount:int>" in yearly


def test_all_sales_is_the_fact(fact):
    assert rows_of(sales.all_sales(fact)) == rows_of(fact)
