"""Compare every registered query with its SQL at a given folder: python check_queries.py FOLDER."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

import __spark_entry__ as contract  # noqa: E402
from compare import connect, difference  # noqa: E402
from merchantry.session import clear_workspace, local_session  # noqa: E402

if __name__ == "__main__":
    folder, only = sys.argv[1], sys.argv[2:]
    spark, con, sql = local_session(), connect(folder), contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        found = difference(query(spark, folder), con, sql[name])
        failed += bool(found)
        print(f"{name:36} {time.time() - start:6.2f}s {found or 'same'}", flush=True)
    clear_workspace(spark)
    print("different:", failed)
