"""Print the formatted physical plan of registered queries.

    python scripts/explain_plans.py [sf_dir] [query ...]

Shows, per scan, the columns read (ReadSchema) and pushed filters, and the
exchanges and join strategies Catalyst chose before adaptive re-planning.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.plans import queries as Q  # noqa: E402
from stratum.session import build_session  # noqa: E402


def summarize(plan: str) -> str:
    ops = re.findall(r"^\(\d+\) (\w+(?: \w+)?)", plan, flags=re.M)
    counts: dict[str, int] = {}
    for o in ops:
        counts[o] = counts.get(o, 0) + 1
    nodes = [n for n in re.split(r"\n\n+", plan) if "ReadSchema: " in n]  # a node's own columns and filters
    scans = [re.search(r"ReadSchema: (struct<[^\n]*>)", n)[1] for n in nodes]
    pushed = [(re.search(r"PushedFilters: (\[[^\n]*\])", n) or [None, "[]"])[1] for n in nodes]
    lines = [f"  operators: {dict(sorted(counts.items()))}"]
    for s, p in zip(scans, pushed):
        lines.append(f"  scan {s[:140]}  pushed={p[:140]}")
    return "\n".join(lines)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or ["fact_listing", "role_counts", "valid_portfolio"]
    spark = build_session()
    for n in names:
        df = Q.QUERIES[n](spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        print(f"== {n}\n{summarize(plan)}")
        if os.environ.get("FULL"):
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()
