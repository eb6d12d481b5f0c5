"""Time each registered query's oracle SQL in DuckDB (single-node yardstick)."""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb  # noqa: E402

from stratum.plans import queries as Q  # noqa: E402
from stratum.sources.standins import DRIVER_TABLES  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
names = sys.argv[2:] or list(Q.ORACLE)
con = duckdb.connect()
for t in DRIVER_TABLES:
    con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
out = {}
for n in names:
    if n not in Q.ORACLE:
        continue
    t0 = time.perf_counter()
    con.sql(Q.ORACLE[n]).to_arrow_table()
    out[n] = round(time.perf_counter() - t0, 3)
print(json.dumps(out))
