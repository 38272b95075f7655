"""Plans that rely on how the star schema is stored, and distinct counts by bitmaps."""

import random
import re
from collections import defaultdict
from datetime import date

import pytest
from helpers import final_plan_of, gold_rows, plan_of, rows_of
from pyspark.sql import functions as F

from merchantry.operators import distinct_counts
from merchantry.plans.catalog import AS_OF, all_queries
from merchantry.plans import gold
from merchantry.plans.gold import YEAR, gold_sales, store_fact
from merchantry.plans.performance import running_total_revenue
from merchantry.plans.sales import average_order_value, key_sales_metrics, order_period
from merchantry.plans.trends import dated_lines, yearly_orders, yearly_revenue
from merchantry.plans.warehouse import Warehouse, open_warehouse
from merchantry.session import unsorted_rows
from merchantry.sources.tables import footer_scan

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()

BY_ORDER = ["yearly_orders", "average_order_value", "average_quantity_per_order", "yearly_average_order_value"]


@pytest.mark.parametrize("name", BY_ORDER)
def test_orders_are_counted_without_a_shuffle(spark, name):
    plan = final_plan_of(QUERIES[name](spark, FOLDER))
    assert "Bucketed: true" in plan
    assert not re.search(r"Exchange hashpartitioning\([^)]*order_number", plan)


@pytest.mark.parametrize("name", ["running_total_revenue", "product_yoy_performance"])
def test_undated_lines_are_not_read(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert re.search(rf"PartitionFilters: \[isnotnull\({YEAR}", plan)


def test_the_metrics_take_one_scan(spark):
    plan = plan_of(QUERIES["key_sales_metrics"](spark, FOLDER))
    assert plan.count("FileScan") == 1 and "Expand" not in plan and "count(distinct" not in plan
    assert "count(distinct" not in plan_of(QUERIES["yearly_active_customers"](spark, FOLDER))


@pytest.mark.parametrize(
    "name, found",
    [("order_period", "MIN(order_date), MAX(order_date)"), ("table_profile", "COUNT(*)")],
)
def test_answers_from_footers(spark, name, found):
    assert f"PushedAggregation: [{found}]" in plan_of(QUERIES[name](spark, FOLDER))


def test_footers_give_what_a_scan_gives(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, NULL, date_add(DATE '2020-01-01', int(id))) AS d", "string(id) AS s")
    df.repartition(5).write.parquet(f"{tmp_path}/t")
    scan = footer_scan(spark, f"{tmp_path}/t", df.schema)
    sums = [F.min("d"), F.max("d"), F.count("d"), F.count(F.lit(1)), F.max("id")]
    assert "PushedAggregation: [MIN(d)" in plan_of(scan.agg(*sums))
    for aggregates in (sums, [*sums, F.max("s")], [F.sum("id"), F.min("d")]):
        assert rows_of(scan.agg(*aggregates)) == rows_of(df.agg(*aggregates))
    assert rows_of(scan.where("id < 10").agg(*sums)) == rows_of(df.where("id < 10").agg(*sums))


LINES = [
    {"order_number": f"SO{k // 3}", "product_key": k % 5 or None, "customer_key": 40_000 * (k % 7),
     "order_date": date(2010 + k % 4, 1, 1 + k % 28) if k % 6 else None, "sales_amount": k, "quantity": 1, "price": k}
    for k in range(200)
]


def test_the_layout_changes_no_answer(spark):
    lines = gold_rows(spark, "sales", *LINES)
    fact, _ = store_fact(lines, "layout")
    assert sorted(map(str, rows_of(fact.drop(YEAR)))) == sorted(map(str, rows_of(lines)))
    for report in (yearly_orders, yearly_revenue, running_total_revenue, average_order_value, key_sales_metrics, order_period):
        assert rows_of(report(fact)) == rows_of(report(lines)), report
    assert None in [r[0] for r in rows_of(yearly_revenue(fact))]
    warehouse = Warehouse({})
    warehouse._fact, warehouse._fact_path = store_fact(lines, "layout")
    warehouse._tables["gold.sales"] = warehouse._fact.drop(YEAR)
    # The files of undated lines have no dates at all.
    assert rows_of(order_period(warehouse.dated_footers())) == rows_of(order_period(lines))
    assert warehouse.footers("gold.sales").count() == len(LINES)
    assert dated_lines(fact).count() == sum(x["order_date"] is not None for x in LINES)


def test_no_lines(spark):
    fact, _ = store_fact(gold_rows(spark, "sales"), "layout")
    assert rows_of(key_sales_metrics(fact)) == rows_of(key_sales_metrics(gold_rows(spark, "sales")))
    assert rows_of(key_sales_metrics(fact)) == [(None, None, None, 0, 0, 0)]
    assert yearly_orders(fact).count() == 0
    warehouse = Warehouse({})
    warehouse._fact, warehouse._fact_path = store_fact(gold_rows(spark, "sales"), "layout")
    warehouse._tables["gold.sales"] = warehouse._fact.drop(YEAR)
    assert rows_of(order_period(warehouse.dated_footers())) == [(None, None, None)]
    assert warehouse.footers("gold.sales").count() == 0


def test_distinct_counts_by_bitmaps(spark):
    r = random.Random(5)
    rows = [
        (r.choice(["x", "y", None]), None if r.random() < 0.1 else r.randrange(1, 200_000),
         1 if r.random() < 0.4 else r.choice([32_768, 32_769, 65_536, 0, None]), r.randrange(9))
        for _ in range(5000)
    ]
    df = spark.createDataFrame(rows, "g string, a long, b int, n int").repartition(6)
    found = distinct_counts(df, {"as_": "a", "bs": "b"}, {"total": F.col("n")}, ["g"])
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    assert sorted(rows_of(found), key=str) == sorted(
        (
            (g, len({x[1] for x in x_} - {None}), len({x[2] for x in x_} - {None}), sum(x[3] for x in x_))
            for g, x_ in groups.items()
        ),
        key=str,
    )
    assert rows_of(distinct_counts(df.where("false"), {"as_": "a"}, {"t": F.col("n")})) == [(0, None)]
    one = distinct_counts(df, {"bs": "b"})
    assert rows_of(one) == [(len({x[2] for x in rows} - {None}),)]


def test_the_warehouse_keeps_nine_columns(spark):
    warehouse = open_warehouse(spark, FOLDER, AS_OF)
    assert YEAR not in warehouse.table("gold.sales").columns and YEAR in warehouse.fact().columns
    assert YEAR not in warehouse.footers("gold.sales").columns


SORTS = ["spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "spark.sql.maxConcurrentOutputFileWriters"]


def test_the_fact_is_built_without_sorts(spark, monkeypatch):
    lines = spark.createDataFrame(
        [(f"SO{k // 3}", f"P{k % 5}", k // 3 % 7, None, None, None, k, 1, k) for k in range(60)],
        "sls_ord_num string, sls_prd_key string, sls_cust_id long, sls_order_dt date, sls_ship_dt date,"
        " sls_due_dt date, sls_sales int, sls_quantity int, sls_price int",
    )
    products = gold_rows(spark, "products", *[{"product_key": k, "product_number": f"P{k}"} for k in range(4)])
    customers = gold_rows(spark, "customers", *[{"customer_key": k + 10, "customer_id": k} for k in (0, 1, 2, 3, 3)])
    broadcasts = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name) for name in SORTS}
    for name in broadcasts:
        spark.conf.set(name, "-1")
    seen = []
    try:
        with unsorted_rows(spark):
            plan = final_plan_of(gold_sales(lines, products, customers)).partition("== Initial Plan ==")[0]
            assert all(spark.conf.get(name) != before[name] for name in SORTS)
        monkeypatch.setattr(gold, "unsorted_rows", lambda s: seen.append(s) or unsorted_rows(s))
        fact, _ = store_fact(gold_sales(lines, products, customers), "unsorted")
        found = rows_of(fact.select("order_number", "product_key", "customer_key", "sales_amount"))
    finally:
        for name in broadcasts:
            spark.conf.unset(name)
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
    assert seen and {name: spark.conf.get(name) for name in SORTS} == before
    expected = [
        (f"SO{k // 3}", k % 5 if k % 5 < 4 else None, c, k)
        for k in range(60)
        for c in {0: [10], 1: [11], 2: [12], 3: [13, 13]}.get(k // 3 % 7, [None])
    ]
    assert sorted(found, key=str) == sorted(expected, key=str)
