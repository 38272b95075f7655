"""Keys and names that differ in case and trailing blanks."""

from helpers import plan_of
from pyspark.sql import functions as F

from merchantry.functions import EXACT, SERVER_COLLATION, collated
from merchantry.operators import following_value, left_lookup
from merchantry.plans import collation
from merchantry.plans.catalog import AS_OF
from merchantry.plans.gold import load_gold, read_gold
from merchantry.plans.silver import load_silver, read_silver
from merchantry.plans.warehouse import open_warehouse
from merchantry.schemas import BRONZE, SILVER
from merchantry.sources.bronze import read_bronze
from merchantry.sources.tables import Release

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def release(spark, folder, tables):
    with Release(spark, folder) as new:
        for name, df in tables.items():
            new.write(df, name)
        new.publish()


def test_columns_are_compared_under_a_collation_and_keep_their_strings(spark):
    df = spark.createDataFrame([("Ab ", 1), ("aB", 2), (None, 3)], "k string, v int")
    like = collated(df, SERVER_COLLATION)
    assert like.where("k = 'AB'").count() == 2 and df.where("k = 'AB'").count() == 0
    assert like.groupBy("k").count().count() == 2
    assert rows(collated(like, EXACT)) == rows(df) and collated(like, EXACT).schema == df.schema
    assert collated(df, None) is df and collated(df, SERVER_COLLATION, "v").schema == df.schema


def test_lookups_and_following_values_go_by_the_collation(spark):
    left = collated(spark.createDataFrame([("Ab ", 1), ("x", 2), (None, 3)], "k string, v int"), SERVER_COLLATION)
    right = collated(spark.createDataFrame([("aB", 10)] * 4 + [("", 11)], "j string, w int"), SERVER_COLLATION)
    for modest in (1_000_000, 2):  # with the second number the key is hot
        found = left_lookup(left, right, "k", "j", modest).select("v", "w")
        assert rows(found) == [(1, 10)] * 4 + [(2, None), (3, None)]
    versions = spark.createDataFrame([("a", 1), ("A  ", 2), ("a", 3), ("b", 1)], "k string, v int")
    found = following_value(collated(versions, SERVER_COLLATION), "k", ["v"], "v", "next")
    assert rows(found.select("v", "next")) == [(1, 2), (1, None), (2, 3), (3, None)]


def test_loads_under_a_collation(spark, tmp_path):
    exact = open_warehouse(spark, FOLDER, AS_OF)
    release(spark, f"{tmp_path}/bronze", {
        t: collation.respelt(exact.table(f"bronze.{t}"), t) for t in BRONZE
    })
    load_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", AS_OF, collation=SERVER_COLLATION)
    load_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/plain", AS_OF)
    assert all(read_silver(spark, f"{tmp_path}/silver", t).schema == SILVER[t] for t in SILVER)
    versions = [exact.table("silver.crm_prd_info")] + [
        read_silver(spark, f"{tmp_path}/{f}", "crm_prd_info") for f in ("silver", "plain")
    ]
    # Every version but the last has an end; keys spelt apart are no versions of each other.
    assert rows(versions[1].select("prd_id", "prd_end_dt")) == rows(versions[0].select("prd_id", "prd_end_dt"))
    assert versions[2].where("prd_end_dt IS NULL").count() > versions[1].where("prd_end_dt IS NULL").count()
    load_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", SERVER_COLLATION)
    load_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/apart")
    joined, apart = (
        read_gold(spark, f"{tmp_path}/{f}", "sales").agg(F.count("product_key")).first()[0] for f in ("gold", "apart")
    )
    assert joined == exact.table("gold.sales").agg(F.count("product_key")).first()[0] > apart
    assert read_gold(spark, f"{tmp_path}/gold", "products").schema["product_number"].dataType.isUTF8BinaryCollation()
    assert read_bronze(spark, f"{tmp_path}/bronze", "crm_prd_info").where("prd_key LIKE '%  '").count() > 0


def test_no_cross_joins(spark):
    exact = open_warehouse(spark, FOLDER, AS_OF)
    parts = [exact.table(t) for t in ("gold.sales", "gold.products", "gold.customers")]
    plan = plan_of(collation.revenue_by_country_and_category(*parts))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lines_are_grouped_by_labels_and_not_under_the_collation(spark):
    products = [(1, "P1", "Toys"), (2, "p1  ", "TOYS "), (3, "ΟΔΟΣ", "toys"), (4, "οδος", "toys"), (5, "P5", None), (6, None, "Bikes")]
    customers = [(1, "de"), (2, "DE "), (3, None), (4, " de")]
    lines = [(p, c, 1) for p in (1, 2, 3, 4, 5, 6, None) for c in (1, 2, 3, 4, None)] * 2
    found = collation.revenue_by_country_and_category(
        spark.createDataFrame(lines, "product_key long, customer_key long, sales_amount long"),
        collated(spark.createDataFrame(products, "product_key long, product_number string, category string"), SERVER_COLLATION),
        collated(spark.createDataFrame(customers, "customer_key long, country string"), SERVER_COLLATION),
    )
    assert "SortAggregate" not in plan_of(found)  # strings under a collation are sorted to be grouped
    per_category = [("bikes", 1, 0), ("toys", 4, 2), (None, 2, 1)]
    assert rows(found) == sorted(
        (
            (country, category, 2 * n * k, 2 * n * k, numbers)
            for country, n in (("de", 2), (" de", 1), (None, 2))
            for category, k, numbers in per_category
        ),
        key=repr,
    )
