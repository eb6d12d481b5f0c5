"""Local correctness gate: each registered Spark query vs its DuckDB SQL.

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name), like the round's verifier.  Usage:

    python scripts/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stratum.plans import queries as Q  # noqa: E402
from stratum.session import build_session  # noqa: E402
from stratum.sources.standins import DRIVER_TABLES  # noqa: E402

EXTRA_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    if isinstance(v, dict):
        return _norm(tuple(v.values()))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(Q.QUERIES)
    spark = build_session()
    con = duckdb.connect()
    for t in DRIVER_TABLES + EXTRA_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for n in names:
        t0 = time.time()
        df = Q.QUERIES[n](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        ts = time.time() - t0
        if n not in Q.ORACLE:
            print(f"{n:28s} spark_rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        rel = con.sql(Q.ORACLE[n])
        ocols = rel.columns
        orows = rel.fetchall()
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        otypes = dict(zip(ocols, (str(t) for t in rel.types)))
        twin = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
                "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}
        tdiff = {c: (stypes[c], otypes.get(c)) for c in stypes if twin.get(stypes[c]) != otypes.get(c)}
        if tdiff:
            print("   type differences", tdiff)
        ok = (len(srows) == len(orows)) and sorted(scols) == sorted(ocols) and hs == ho and not tdiff
        bad += not ok
        print(f"{n:28s} {'OK ' if ok else 'BAD'} rows {len(srows)}/{len(orows)} {ts:.1f}s")
        if not ok:
            if sorted(scols) != sorted(ocols):
                print("   cols spark-only", sorted(set(scols) - set(ocols)), "oracle-only", sorted(set(ocols) - set(scols)))
            else:
                diff_s = sorted(set(ls) - set(lo))[:3]
                diff_o = sorted(set(lo) - set(ls))[:3]
                print("   cols", sorted(scols))
                for d in diff_s:
                    print("   spark :", d[:400])
                for d in diff_o:
                    print("   oracle:", d[:400])
    print("mismatches:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
