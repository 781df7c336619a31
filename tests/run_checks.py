"""Compare every query with its SQL twin: ``run_checks.py [scale] [name...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from tests.compare import connect, difference  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
sf_dir = f"/root/testdata/sf{sf}"
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "12g")
    .config("spark.ui.enabled", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
queries, oracles = e.queries(), e.oracle_sql()
names = sys.argv[2:] or list(queries)
bad = 0
for name in names:
    t0 = time.time()
    try:
        df = queries[name](spark, sf_dir)
        msg = difference(df, con, oracles[name]) if name in oracles else f"(rows only) {df.count()}"
    except Exception as ex:
        msg = f"ERROR {type(ex).__name__} {str(ex)[:600]}"
    ok = msg is None or msg.startswith("(rows")
    bad += not ok
    print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - t0:6.2f}s {msg or ''}", flush=True)
print(f"{len(names)} queries, {bad} bad, {sum(n in oracles for n in names)} with SQL")
