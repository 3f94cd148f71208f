"""Per-stage task balance from a Spark event log (uncompressed, non-rolling): tasks, total records in, largest
task's records and its share. A stage whose largest task carries most of the records is a skew bottleneck.

usage: python scripts/stage_report.py <event log file or folder>
"""
from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def records_in(m: dict) -> int:
    sr = m.get("Shuffle Read Metrics", {})
    inp = m.get("Input Metrics", {})
    return int(sr.get("Total Records Read", 0)) + int(inp.get("Records Read", 0))


def main(path: str) -> None:
    if os.path.isdir(path):
        path = [p for p in glob.glob(os.path.join(path, "*")) if os.path.isfile(p)][0]
    tasks = defaultdict(list)
    names = {}
    group = {}
    for line in open(path):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id", "")
            for sid in e.get("Stage IDs", []):
                group[sid] = g
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            tasks[e["Stage ID"]].append(records_in(e["Task Metrics"]))
        elif e["Event"] == "SparkListenerStageCompleted":
            names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    for sid in sorted(tasks):
        recs = tasks[sid]
        tot = sum(recs)
        mx = max(recs)
        share = mx / tot if tot else 0.0
        print(f"stage {sid:4d} group={group.get(sid, ''):10s} tasks={len(recs):4d} records={tot:10d} max_task={mx:10d} "
              f"share={share:5.2f} {names.get(sid, '')}")


if __name__ == "__main__":
    main(sys.argv[1])
