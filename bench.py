"""Time the warehouse build, every report and the loads; prints one line of JSON.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Each query runs twice and the second time counts, as the first one includes
code generation; results go to a sink that computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import time

from merchantry.plans.catalog import AS_OF, REPORTS, all_queries
from merchantry.plans.gold import load_gold
from merchantry.plans.silver import load_silver
from merchantry.plans.warehouse import open_warehouse
from merchantry.session import clear_workspace, local_session, workspace
from merchantry.sources.bronze import SOURCE_FILES, load_bronze
from merchantry.sources.sample_data import write_raw_csv


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()
    warehouse = open_warehouse(spark, folder, AS_OF)
    times = {
        f"build_{table.replace('.', '_')}": timed(lambda: warehouse.table(table))
        for table in ("gold.customers", "gold.products", "gold.sales")
    }
    queries = all_queries()
    for report in REPORTS:
        name = report.__name__

        def run() -> None:
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()

        run()
        times[name] = timed(run)
    root = f"{workspace(spark)}/bench-load"
    for table, file in SOURCE_FILES.items():
        write_raw_csv(warehouse.table(f"bronze.{table}"), f"{root}/in/{file}")
    times["load_bronze"] = timed(lambda: load_bronze(spark, f"{root}/in", f"{root}/bronze"))
    times["load_silver"] = timed(lambda: load_silver(spark, f"{root}/bronze", f"{root}/silver", AS_OF))
    times["load_gold"] = timed(lambda: load_gold(spark, f"{root}/silver", f"{root}/gold"))
    clear_workspace(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warehouse build and report time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
