"""Every registered query against the same question in SQL on another engine."""

import shutil

import __spark_entry__ as contract
import pytest
from compare import connect, difference
from helpers import plan_of

from merchantry.oracle import oracle_queries
from merchantry.plans.catalog import AS_OF, all_queries
from merchantry.plans.warehouse import open_warehouse
from merchantry.session import clear_workspace
from merchantry.sources.sample_data import SAMPLE_TABLES

FOLDER = "/root/testdata/sf0.001"

QUERIES, SQL = all_queries(), oracle_queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert difference(df, duck, SQL[name]) == ""


def test_the_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_a_warehouse_is_built_once_and_again_after_clearing(spark):
    first = open_warehouse(spark, FOLDER, AS_OF)
    rows = first.table("gold.customers").count()
    assert open_warehouse(spark, FOLDER, AS_OF) is first
    clear_workspace(spark)
    second = open_warehouse(spark, FOLDER, AS_OF)
    assert second is not first and second.table("gold.customers").count() == rows


def test_a_changed_table_makes_another_warehouse(spark, tmp_path):
    for table in SAMPLE_TABLES:
        shutil.copy(f"{FOLDER}/{table}.parquet", tmp_path)
    first = open_warehouse(spark, str(tmp_path))
    assert open_warehouse(spark, str(tmp_path)) is first
    part = tmp_path / "part.parquet"
    part.chmod(0o644)
    shutil.copy("/root/testdata/sf0.01/part.parquet", part)
    second = open_warehouse(spark, str(tmp_path))
    assert second.table("gold.products").count() == 2000
