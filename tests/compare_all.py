"""Run registered queries at a folder and report differences and times (not a test)."""

import sys
import time

sys.path[:0] = ["/root/repo", "/root/repo/tests"]
from compare import differences, run_sql  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
names = sys.argv[2:] or list(entry.queries())
oracles = entry.oracle_sql()
bad = 0
for name in names:
    start = time.time()
    try:
        df = entry.queries()[name](spark, folder)
        if name in oracles:
            mid = time.time()
            expected = run_sql(folder, oracles[name])
            sql_time = time.time() - mid
            verdict = differences(df, expected) or f"ok {len(expected)}"
            verdict += f" (sql {sql_time:.1f})"
        else:
            rows = df.collect()
            verdict = f"rows {len(rows)} {rows[0] if rows else ''}"[:200]
    except Exception as problem:
        verdict = f"FAILED {type(problem).__name__}: {str(problem)[:700]}"
    if not verdict.startswith(("ok", "rows")):
        bad += 1
    print(f"{time.time() - start:6.1f} {name}: {verdict}", flush=True)
print("bad", bad)
