"""Command line check: python tests/check_queries.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import differences, sql_engine  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    folder = f"/root/testdata/{sf}"
    spark = get_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = sql_engine(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                problems = differences(df, con, sql[name])
                note = "sql"
            else:
                note = f"rows={len(df.collect())}"
                problems = []
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {note} {time.time() - start:.2f}s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
