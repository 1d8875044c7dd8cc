"""Summarise the physical plan of every registered query (markdown table).

    python tools/plan_summary.py [sf_dir] > table.md

Counts the shuffles (hash / single-partition), broadcasts, join and aggregate
operators, windows, and the filters pushed into each parquet scan, from the
plan Spark runs (``executedPlan`` before adaptive re-planning).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folio.plans import registry  # noqa: E402
from folio.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast": len(re.findall(r"BroadcastExchange", plan)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                       r"BroadcastNestedLoopJoin|CartesianProduct)", plan))),
        "aggs": sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", plan))),
        "window": "Window" in plan,
        "scans": [(cols.count(",") + 1 if cols else 0, pushed) for _, cols, pushed in scans],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| Query | Hash shuffles | Single-partition | Broadcasts | Joins | Aggregates | Window | Scans: columns read / pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in registry.QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        scans = "; ".join(f"{n} cols" + (f" / {p}" if p else "") for n, p in s["scans"])
        print(f"| `{name}` | {s['hash']} | {s['single']} | {s['broadcast']} | {', '.join(s['joins']) or '-'} | "
              f"{', '.join(s['aggs']) or '-'} | {'yes' if s['window'] else '-'} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
