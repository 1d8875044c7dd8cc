"""Per-query work from Spark's event log: tasks, task time, shuffle written.

    python tools/stage_metrics.py [sf_dir] > table.md

Runs every registered query once through the ``noop`` sink with the event log
written to a fresh scratch folder, tags each query's jobs with its name, and
sums the task metrics of those jobs (driver-side planning jobs included).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folio.plans import registry  # noqa: E402
from folio.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = list(registry.QUERIES)
    for name, fn in registry.QUERIES.items():
        spark.sparkContext.setJobDescription(f"query:{name}")
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_query: dict[int, str] = {}
    totals = defaultdict(lambda: defaultdict(int))
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    if desc.startswith("query:"):
                        for sid in ev.get("Stage IDs", []):
                            stage_query[sid] = desc[len("query:"):]
                elif kind == "SparkListenerTaskEnd":
                    q = stage_query.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not q or not m:
                        continue
                    t = totals[q]
                    t["tasks"] += 1
                    t["run_ms"] += m.get("Executor Run Time", 0)
                    t["read"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    t["shuffle"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    t["spill"] += m.get("Disk Bytes Spilled", 0)
    mb = 1024 ** 2
    # Input bytes are not reported for every file scan, so they are not shown.
    print("| Query | Tasks | Task time (s) | Shuffle written (MB) | Spilled (MB) |")
    print("| --- | --- | --- | --- | --- |")
    for name in names:
        t = totals.get(name, {})
        print(f"| `{name}` | {t.get('tasks', 0)} | {t.get('run_ms', 0) / 1000:.2f} | "
              f"{t.get('shuffle', 0) / mb:.3f} | {t.get('spill', 0) / mb:.2f} |")


if __name__ == "__main__":
    main()
