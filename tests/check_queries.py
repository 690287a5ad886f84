"""Run registered queries against their SQL: python tests/check_queries.py [sf] [name-part ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from oracle import connect, differences
from pyspark.sql import SparkSession

import __spark_entry__ as entry

sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
parts = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con, sqls, failed = connect(sf), entry.oracle_sql(), 0
for name, fn in entry.queries().items():
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        if name in sqls:
            problem = differences(spark, con, sf, fn, sqls[name])
            n = con.execute(f"select count(*) from ({sqls[name]}) q").fetchall()[0][0]
        else:
            n, problem = len(fn(spark, sf).collect()), None
    except Exception as e:  # report and go on with the next query
        problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        if parts:
            traceback.print_exc()
    failed += problem is not None
    print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {time.time() - start:6.2f}s rows={n}{'' if name in sqls else ' (no sql)'} {problem or ''}", flush=True)
print("failed:", failed)
spark.stop()
