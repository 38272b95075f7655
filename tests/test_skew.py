"""All queries over sample tables in which one key holds a third of the rows.

Nothing is broadcast by size, small partitions count as skewed ones, and
shuffle partitions stay apart, so the plans are those of large tables.
"""

import duckdb
import pytest
from compare import TABLES, connect, difference

from merchantry.oracle import oracle_queries
from merchantry.plans.catalog import all_queries

SAMPLE = "/root/testdata/sf0.001"

SKEWED = {
    "lineitem": """SELECT * EXCLUDE (i) REPLACE (
        CASE WHEN i % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey,
        CASE WHEN i % 3 = 1 THEN 216 ELSE l_orderkey END AS l_orderkey)""",
    "orders": "SELECT * EXCLUDE (i) REPLACE (CASE WHEN i % 3 = 0 THEN 4 ELSE o_custkey END AS o_custkey)",
    # One nation for a third of the customers; three customers come three times.
    "customer": """SELECT * EXCLUDE (i) REPLACE (
        CASE WHEN i % 3 = 0 THEN 6 ELSE c_nationkey END AS c_nationkey,
        CASE WHEN i < 9 THEN i % 3 ELSE c_custkey END AS c_custkey)""",
    # One category for a third of the products, one product key for a tenth, some exact copies.
    "part": """SELECT CASE WHEN i % 10 = 0 THEN 8 ELSE p_partkey END AS p_partkey,
        CASE WHEN i % 20 = 0 THEN 'same' ELSE p_name END AS p_name,
        CASE WHEN i % 3 = 0 OR i % 10 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand,
        CASE WHEN i % 3 = 0 OR i % 10 = 0 THEN 'SMALL' ELSE p_type END AS p_type,
        CASE WHEN i % 20 = 0 THEN 1 ELSE p_size END AS p_size,
        CASE WHEN i % 20 = 0 THEN 900.5 ELSE p_retailprice END AS p_retailprice""",
}

LARGE_TABLE_PLANS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}

QUERIES, SQL = all_queries(), oracle_queries()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for table in TABLES:
        source = f"(SELECT *, row_number() OVER () - 1 AS i FROM '{SAMPLE}/{table}.parquet')"
        body = f"{SKEWED.get(table, 'SELECT * EXCLUDE (i)')} FROM {source}"
        duckdb.sql(f"COPY ({body}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.fixture(scope="module")
def large(spark):
    before = {name: spark.conf.get(name, None) for name in LARGE_TABLE_PLANS}
    for name, value in LARGE_TABLE_PLANS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("csv_")])
def test_query(large, duck, folder, name):
    assert difference(QUERIES[name](large, folder), duck, SQL[name]) == ""
