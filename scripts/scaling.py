"""Scaling evidence from Spark's event log (written to a scratch folder, no UI).

usage: python scripts/scaling.py [query ...]

For each scale factor a fresh application runs the queries with the ``noop``
sink; the event log then gives, per stage, the shuffle records each task read.
Reported per query: seconds, scanned and shuffled records, and the largest
share of a big shuffle stage (>= 5% of the query's shuffled records) read by a
single task.  A share near 1/tasks means the work is spread; near 1 means one
task.  (Scans are not scored: each test table is one small Parquet file.)
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

DEFAULT = ["sliding_mav", "sliding_full_features", "sliding_panes", "label_majority", "kalman_smooth", "knn_vote", "bad_channels", "split_by_class"]


def run(sf_dir: str, names: list[str], cores: int = 8) -> dict:
    log_dir = tempfile.mkdtemp(prefix="myosig-events-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", str(2 * cores))
        # AQE would (rightly) merge these few-MB shuffles into one task; turn that off so the
        # share below shows how the plan itself spreads the work.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    from myosig.plans import all_queries
    from myosig.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    qs = all_queries()
    timings = {}
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        t0 = time.perf_counter()
        qs[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[n] = time.perf_counter() - t0
        spark.catalog.clearCache()
    spark.stop()
    stage_group, task_recs, scan_recs = {}, defaultdict(list), defaultdict(int)
    for path in [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            job_group = {}
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        job_group[sid] = g
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    scan = (m.get("Input Metrics") or {}).get("Records Read", 0)
                    shuf = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    sid = e["Stage ID"]
                    stage_group[sid] = job_group.get(sid)
                    task_recs[sid].append(shuf)
                    scan_recs[sid] += scan
    out = {}
    for n in names:
        stages = [s for s, g in stage_group.items() if g == n]
        total = sum(sum(task_recs[s]) for s in stages)
        share, tasks = 0.0, 0
        for s in stages:
            st = sum(task_recs[s])
            if total and st >= 0.05 * total and st > 0:
                if max(task_recs[s]) / st > share:
                    share, tasks = max(task_recs[s]) / st, len(task_recs[s])
        out[n] = {
            "sec": round(timings[n], 2),
            "scan_records": sum(scan_recs[s] for s in stages),
            "shuffle_records": total,
            "max_task_share": round(share, 3),
            "tasks_in_that_stage": tasks,
        }
    return out


def main():
    names = sys.argv[1:] or DEFAULT
    rows = []
    for sf in ["0.001", "0.01", "0.1"]:
        res = run(f"/root/testdata/sf{sf}", names)
        for n, r in res.items():
            rows.append((n, sf, r))
            print(json.dumps({"query": n, "sf": sf, **r}), flush=True)
    print("\n| query | sf | sec | scan records | shuffle records | max single-task share of a big shuffle stage (tasks) |")
    print("| --- | --- | --- | --- | --- | --- |")
    for n, sf, r in sorted(rows):
        print(f"| {n} | {sf} | {r['sec']} | {r['scan_records']} | {r['shuffle_records']} | {r['max_task_share']} ({r['tasks_in_that_stage']}) |")


if __name__ == "__main__":
    main()
