"""Compare all (or the named) queries with their SQL: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from lodestrata.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    if os.environ.get("PLAIN"):  # a session without the library's settings
        spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("check", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        began = time.time()
        try:
            if name in oracles:
                problem, rows, _ = compare(spark, con, fn, oracles[name], folder)
                if problem and compare(spark, con, fn, oracles[name], folder, 10)[0] is None:
                    problem = "only close: " + problem
            else:
                problem, rows = None, fn(spark, folder).collect()
            note = problem or ("ok" if name in oracles else "rows only")
            if len(rows) == 0:
                note += " EMPTY"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem, rows, note = str(e), [], "ERROR " + str(e).strip()[:700]
            if wanted:
                traceback.print_exc()
        failed += bool(problem)
        print(f"{name:36s} {len(rows):7d} rows {time.time() - began:6.2f}s  {note[:900]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
