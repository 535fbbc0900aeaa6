"""Run queries against their SQL: python tests/check.py [sf] [name ...]"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
names = sys.argv[2:] or list(entry.queries())
path = f"/root/testdata/sf{sf}"
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.memory", "12g").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(path)
bad = 0
for n in names:
    t = time.time()
    try:
        df = entry.queries()[n](spark, path)
        sql = entry.oracle_sql().get(n)
        res = f"no sql, {df.count()} rows" if sql is None else compare(df, con, sql)
    except Exception as e:  # noqa: BLE001
        res = f"ERROR {str(e)[:1500]}"
    ok = res is None or res.startswith("no sql")
    bad += not ok
    print(f"{'ok ' if ok else 'BAD'} {n} {time.time() - t:.1f}s {'' if res is None else res}", flush=True)
print("bad:", bad)
