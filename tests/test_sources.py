import time
from datetime import date, datetime
from pathlib import Path

import pytest
from helpers import bronze_rows, counted, rows_of
from pyspark.sql import functions as F

import merchantry.plans.gold as gold_plans
from merchantry.plans.gold import load_gold, read_gold
from merchantry.plans.sales import revenue_by_country
from merchantry.plans.silver import load_silver, publish_silver, read_silver
from merchantry.schemas import AUDIT_COLUMN, BRONZE, GOLD, SILVER
from merchantry.session import SHUFFLE_CLEANUP, scratch, store, workspace
from merchantry.sources.bronze import (
    SOURCE_FILES,
    LoadCount,
    TooManyErrors,
    load_bronze,
    load_raw_table,
    publish_bronze,
    read_bronze,
    read_rejects,
)
from merchantry.sources import sample_data, tables
from merchantry.sources.sample_data import raw_tables, write_raw_csv
from merchantry.sources.tables import (
    LayerBusy,
    Release,
    current_release,
    exists,
    publish,
    read_table,
    replace_table,
)

SAMPLE = "/root/testdata/sf0.001"

# Fixed data: lines as they are delivered.
PRODUCTS = (
    "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\r\n"
    "210,CO-RF-FR-R92B-58,HL Road Frame - Black- 58,,R ,2003-07-01,\r\n"
    '212,AC-HE-HL-U509-R,"Sport" Helmet,12,S ,2011-07-01,2007-12-28\r\n'
)


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def load_products(spark, folder, text, **options):
    file = folder / "prd_info.csv"
    file.write_bytes(text.encode())
    return load_raw_table(
        spark, str(file), str(folder / "crm_prd_info"), BRONZE["crm_prd_info"], **options
    )


def test_delivered_lines_are_kept_as_they_are(spark, folder):
    assert load_products(spark, folder, PRODUCTS) == LoadCount(2, 0)
    df = read_bronze(spark, str(folder), "crm_prd_info")
    assert df.schema == BRONZE["crm_prd_info"]
    assert sorted(rows_of(df)) == [
        (210, "CO-RF-FR-R92B-58", "HL Road Frame - Black- 58", None, "R ", datetime(2003, 7, 1), None),
        (212, "AC-HE-HL-U509-R", '"Sport" Helmet', 12, "S ", datetime(2011, 7, 1),
         datetime(2007, 12, 28)),
    ]


def test_columns_are_mapped_by_position(spark, folder):
    load_products(spark, folder, PRODUCTS.replace("prd_id,prd_key", "KEY,ID"))
    assert read_bronze(spark, str(folder), "crm_prd_info").count() == 2


def test_malformed_lines_go_to_the_rejects(spark, folder):
    bad = ["x1,K,N,1,R,2003-07-01,", "1,K,N,1,R,not a day,", "1,K"]
    text = PRODUCTS + "".join(f"{line}\r\n" for line in bad)
    assert load_products(spark, folder, text) == LoadCount(2, 3)
    rejects = read_rejects(spark, str(folder), "crm_prd_info")
    assert sorted(rows_of(rejects.select("bad_line"))) == sorted((line,) for line in bad)
    places = {(r["bad_file"].rpartition("/")[2], r["bad_block"]) for r in rejects.collect()}
    assert len(places) == 1 and places.pop()[1] == 0 and rejects.first()["bad_file"].startswith("file:/")
    assert read_bronze(spark, str(folder), "crm_prd_info").count() == 2


def test_too_many_malformed_lines_leave_the_old_table(spark, folder):
    load_products(spark, folder, PRODUCTS)
    bad = PRODUCTS + "x,K,N,1,R,2003-07-01,\r\n" * 11
    with pytest.raises(TooManyErrors):
        load_products(spark, folder, bad, max_errors=10)
    assert read_bronze(spark, str(folder), "crm_prd_info").count() == 2
    assert len(list(folder.glob("_v-*"))) == 1


def test_any_number_of_malformed_lines_is_kept_by_default(spark, folder):
    bad = PRODUCTS + "x,K,N,1,R,2003-07-01,\r\n" * 11
    assert load_products(spark, folder, bad) == LoadCount(2, 11)
    assert read_rejects(spark, str(folder), "crm_prd_info").count() == 11


def test_a_number_with_spaces_around_it_is_malformed(spark, folder):
    assert load_products(spark, folder, PRODUCTS.replace("\n210,", "\n 210,")) == LoadCount(1, 1)


def test_an_empty_file_makes_an_empty_table(spark, folder):
    assert load_products(spark, folder, PRODUCTS.split("\r\n")[0] + "\r\n") == LoadCount(0, 0)
    assert read_bronze(spark, str(folder), "crm_prd_info").count() == 0


def test_scan_of_a_raw_table_filters_the_rejects_and_skips_unused_columns(spark, folder):
    load_products(spark, folder, PRODUCTS + "x,K,N,1,R,2003-07-01,\r\n")
    plan = (
        read_bronze(spark, str(folder), "crm_prd_info").select("prd_id")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PushedFilters: [IsNull(bad_line)]" in plan
    assert "ReadSchema: struct<prd_id:bigint,bad_line:string>" in plan


def test_full_refresh_replaces(spark, folder):
    path = str(folder / "t")
    replace_table(spark.range(3), path)
    old = read_table(spark, path)
    # The old rows can be read while the new ones are written, and after that.
    replace_table(old.where("id > 0"), path)
    assert sorted(rows_of(read_table(spark, path))) == [(1,), (2,)]
    assert old.count() == 3
    replace_table(spark.range(1), path)
    assert read_table(spark, path).count() == 1 and len(list(folder.glob("_v-*"))) == 3
    replace_table(spark.range(1), path)
    assert len(list(folder.glob("_v-*"))) == 3 and not list(folder.glob("_writer-*"))


def test_a_failed_refresh_leaves_the_old_table(spark, folder):
    path = str(folder / "t")
    replace_table(spark.range(3), path)
    failing = spark.range(3).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(failing, path)
    assert read_table(spark, path).count() == 3
    assert len(list(folder.glob("_v-*"))) == 1


@pytest.mark.parametrize("step", ["written", "named", "half a name"])
def test_an_interrupted_refresh_leaves_the_old_tables(spark, folder, step):
    path = str(folder)
    with Release(spark, path) as release:
        release.write(spark.range(3), "a")
        release.write(spark.range(3), "b")
        release.publish()
    with pytest.raises(KeyboardInterrupt), Release(spark, path) as release:
        release.write(spark.range(5), "a")
        if step != "written":
            text = '{"a": "nowhere' if step == "half a name" else ""
            (folder / "_release-00000002").write_text(text)
        raise KeyboardInterrupt
    assert [read_table(spark, f"{path}/{t}").count() for t in ("a", "b")] == [3, 3]
    with Release(spark, path) as release:
        release.write(spark.range(7), "a")
        release.publish()
    assert [read_table(spark, f"{path}/{t}").count() for t in ("a", "b")] == [7, 3]
    assert current_release(spark, path)[0] > 1


def test_scratch_removes_what_is_not_kept(spark):
    with scratch(spark):
        gone, kept = store(spark.range(2), "gone"), store(spark.range(2), "kept", keep=True)
        paths = [x.inputFiles()[0].rpartition("/")[0] for x in (gone, kept)]
    assert [exists(spark, p) for p in paths] == [False, True]


def test_a_stored_table_leaves_no_shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [Path(d) for d in env.blockManager().diskBlockManager().localDirsString()]

    def files():
        return {f for d in folders for f in d.rglob("shuffle_*")}

    before = files()
    store(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    until = time.time() + 10  # they are removed beside the job
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_intermediate_tables_lie_in_the_shared_folder(spark):
    assert workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    stored = store(spark.range(5), "five")
    assert stored.count() == 5 and stored.inputFiles()[0].startswith(f"file://{workspace(spark)}")


def deliver(spark, folder):
    for table, df in raw_tables(spark, SAMPLE).items():
        write_raw_csv(df, f"{folder}/in/{SOURCE_FILES[table]}")


def test_the_whole_way_from_files_to_the_star_schema(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    counts = load_bronze(spark, f"{root}/in", f"{root}/bronze")
    assert list(counts) == list(BRONZE) and all(c.rejected == 0 for c in counts.values())
    raw = raw_tables(spark, SAMPLE)
    assert {t: c.loaded for t, c in counts.items()} == {t: df.count() for t, df in raw.items()}

    stamp = datetime(2024, 1, 2)
    rejected = load_silver(
        spark, f"{root}/bronze", f"{root}/silver", as_of=date(2025, 1, 1), load_ts=stamp
    )
    assert set(rejected.values()) == {0}
    for table in SILVER:
        df = read_silver(spark, f"{root}/silver", table)
        assert df.schema == SILVER[table]
        assert df.where(F.col(AUDIT_COLUMN) != F.lit(stamp)).count() == 0

    load_gold(spark, f"{root}/silver", f"{root}/gold")
    publish_bronze(spark, f"{root}/bronze")
    publish_silver(spark, f"{root}/silver")
    publish(spark, "gold", f"{root}/gold", GOLD)
    for table in BRONZE:
        assert spark.table(f"bronze.{table}").count() == counts[table].loaded
        assert spark.table(f"silver.{table}").schema.simpleString() == SILVER[table].simpleString()
    assert spark.table("gold.sales").schema == GOLD["sales"]
    lines = read_silver(spark, f"{root}/silver", "crm_sales_details")
    assert spark.table("gold.sales").count() == lines.count()
    for dimension, key in (("customers", "customer_key"), ("products", "product_key")):
        keys = sorted(r[0] for r in spark.table(f"gold.{dimension}").select(key).collect())
        assert keys == list(range(1, len(keys) + 1))

    fact, customers = spark.table("gold.sales"), spark.table("gold.customers")
    parts = revenue_by_country(fact, customers).agg(F.sum("revenue")).first()[0]
    assert parts == fact.agg(F.sum("sales_amount")).first()[0]

    # A second run over the same files changes nothing.
    first = counted(spark.table("gold.sales"))
    load_gold(spark, f"{root}/silver", f"{root}/gold")
    publish(spark, "gold", f"{root}/gold", GOLD)
    assert counted(spark.table("gold.sales")) == first


def test_delivered_files_are_compressed_and_bounded(spark, folder, monkeypatch):
    monkeypatch.setattr(sample_data, "LINES_PER_FILE", 40)
    schema = BRONZE["erp_loc_a101"]
    rows = [(f" AW-{k:08d}", None if k % 7 == 0 else f" place {k % 3} ") for k in range(100)]
    write_raw_csv(spark.createDataFrame(rows, schema).coalesce(1), f"{folder}/loc_a101.csv")
    files = list((folder / "loc_a101.csv").glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".csv.gz") for f in files)
    read = load_raw_table(spark, f"{folder}/loc_a101.csv", f"{folder}/erp_loc_a101", schema)
    assert read == LoadCount(100, 0)
    assert sorted(map(tuple, read_bronze(spark, str(folder), "erp_loc_a101").collect())) == sorted(rows)


def test_an_error_ends_the_silver_load_and_keeps_old_tables(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    load_silver(spark, f"{root}/bronze", f"{root}/silver")
    before = {t: counted(read_silver(spark, f"{root}/silver", t)) for t in SILVER}
    other = spark.range(1).selectExpr("array('many') AS sls_quantity", "CAST(NULL AS STRING) AS bad_line")
    replace_table(other, f"{root}/bronze/crm_sales_details")
    with pytest.raises(Exception, match="sls_quantity"):
        load_silver(spark, f"{root}/bronze", f"{root}/silver")
    for table in SILVER:
        assert counted(read_silver(spark, f"{root}/silver", table)) == before[table]
    assert not list((folder / "silver").glob("_writer-*"))


def test_a_failed_raw_table_leaves_all_six(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    before = {t: counted(read_bronze(spark, f"{root}/bronze", t)) for t in BRONZE}
    (folder / "bad.csv").write_text("id,cat\nx\n")
    (folder / "loc.csv").write_text("cid,cntry\nother,place\n")
    files = {t: f"in/{f}" for t, f in SOURCE_FILES.items()} | {"erp_loc_a101": "loc.csv"}
    with pytest.raises(TooManyErrors, match="bad.csv"):
        load_bronze(spark, root, f"{root}/bronze", 0, files | {"erp_px_cat_g1v2": "bad.csv"})
    with pytest.raises(Exception, match="nowhere.csv"):
        load_bronze(spark, root, f"{root}/bronze", 0, files | {"crm_sales_details": "nowhere.csv"})
    assert {t: counted(read_bronze(spark, f"{root}/bronze", t)) for t in BRONZE} == before
    assert len(list((folder / "bronze").glob("_v-*"))) == 1


def test_readers_keep_their_rows_across_loads(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    load_silver(spark, f"{root}/bronze", f"{root}/silver")
    opened = {t: read_silver(spark, f"{root}/silver", t) for t in SILVER}
    raw = {t: read_bronze(spark, f"{root}/bronze", t) for t in BRONZE}
    rows = {t: df.count() for t, df in opened.items()}
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    load_silver(spark, f"{root}/bronze", f"{root}/silver")
    assert {t: len(df.collect()) for t, df in opened.items()} == rows
    assert all(len(df.collect()) for df in raw.values())
    # A release of all six tables, and the one before it.
    assert len(list((folder / "silver").glob("_release-*"))) == 2
    assert len({p.rpartition("/")[0] for p in current_release(spark, f"{root}/silver")[1].values()}) == 1
    for _ in range(2):
        load_silver(spark, f"{root}/bronze", f"{root}/silver")
        assert len(list((folder / "silver").glob("_v-*"))) == 3


def test_a_layer_has_one_writer(spark, folder, monkeypatch):
    path = str(folder)
    replace_table(spark.range(3), f"{path}/a")
    with Release(spark, path) as release:
        release.write(spark.range(5), "a")
        with pytest.raises(LayerBusy):
            replace_table(spark.range(9), f"{path}/a")
        release.publish()
    assert read_table(spark, f"{path}/a").count() == 5
    # One that died without a word is in the way until it is stale.
    (folder / "_writer-dead").touch()
    (folder / "_v-dead" / "a").mkdir(parents=True)
    with pytest.raises(LayerBusy):
        replace_table(spark.range(9), f"{path}/a")
    assert (folder / "_v-dead").exists()
    monkeypatch.setattr(tables, "STALE_SECONDS", 0)
    replace_table(spark.range(9), f"{path}/a")
    assert read_table(spark, f"{path}/a").count() == 9
    assert not (folder / "_v-dead").exists() and not (folder / "_writer-dead").exists()


def test_an_inserted_row_gets_its_load_time(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    load_silver(spark, f"{root}/bronze", f"{root}/silver", load_ts=datetime(2024, 1, 2, 3, 4, 5))
    publish_silver(spark, f"{root}/silver")
    spark.sql("INSERT INTO silver.erp_loc_a101 (cid, cntry) VALUES ('new', 'Here')")
    spark.sql("INSERT INTO silver.erp_loc_a101 VALUES ('old', 'There', TIMESTAMP '2020-01-01')")
    found = dict(spark.sql(
        f"SELECT cid, cast({AUDIT_COLUMN} AS string) FROM silver.erp_loc_a101 WHERE cid IN ('new', 'old')"
    ).collect())
    assert found["old"].startswith("2020-01-01") and found["new"] > "2024-02"
    others = spark.sql(f"SELECT DISTINCT {AUDIT_COLUMN} FROM silver.erp_cust_az12").collect()
    assert [str(r[0]) for r in others] == ["2024-01-02 03:04:05"]


def test_values_that_are_no_dates_are_counted(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    sales = SOURCE_FILES["crm_sales_details"]
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    (folder / "bad.csv").write_text(
        "header\nSO1,X,1,20101350,20101301,0,1,1,1\nSO2,X,1,20101350,20101229,5,1,1,1\n"
    )
    load_bronze(spark, root, f"{root}/bronze", files={
        **{t: f"in/{f}" for t, f in SOURCE_FILES.items()}, "crm_sales_details": "bad.csv"
    })
    assert sales and load_silver(spark, f"{root}/bronze", f"{root}/silver") == {
        "sls_order_dt": 2, "sls_ship_dt": 1, "sls_due_dt": 0, "sls_sales": 0
    }


def test_amounts_beyond_the_range_are_counted_and_do_not_end_the_load(spark, folder):
    deliver(spark, folder)
    root = str(folder)
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    row = {"sls_sales": 1, "sls_quantity": 2**31 - 1, "sls_price": 2**31 - 1}
    replace_table(
        bronze_rows(spark, "crm_sales_details", row).selectExpr("*", "CAST(NULL AS STRING) AS bad_line"),
        f"{root}/bronze/crm_sales_details",
    )
    assert load_silver(spark, f"{root}/bronze", f"{root}/silver")["sls_sales"] == 1
    assert read_silver(spark, f"{root}/silver", "crm_sales_details").first().sls_sales is None


def test_a_failed_gold_load_leaves_one_star_schema(spark, folder, monkeypatch):
    deliver(spark, folder)
    root = str(folder)
    load_bronze(spark, f"{root}/in", f"{root}/bronze")
    load_silver(spark, f"{root}/bronze", f"{root}/silver")
    load_gold(spark, f"{root}/silver", f"{root}/gold")

    def revenue():
        tables = (read_gold(spark, f"{root}/gold", t) for t in ("sales", "customers"))
        return counted(revenue_by_country(*tables))

    before = revenue()
    customers = read_silver(spark, f"{root}/silver", "crm_cust_info")
    new = customers.limit(1).withColumn("cst_id", F.lit(-5).cast(dict(customers.dtypes)["cst_id"]))
    replace_table(customers.unionByName(new), f"{root}/silver/crm_cust_info")
    with monkeypatch.context() as patch:
        def fails(*_):
            raise KeyboardInterrupt
        patch.setattr(gold_plans, "gold_sales", fails)
        with pytest.raises(KeyboardInterrupt):
            load_gold(spark, f"{root}/silver", f"{root}/gold")
    assert revenue() == before
    load_gold(spark, f"{root}/silver", f"{root}/gold")
    assert sum(r[1] * n for r, n in revenue().items()) == sum(r[1] * n for r, n in before.items())
    assert read_gold(spark, f"{root}/gold", "customers").where("customer_id = -5").count() == 1
