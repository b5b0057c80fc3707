"""Per-query stage metrics from Spark's event log.

usage: python tools/stage_report.py [--sf DIR] [name ...]

Runs each registered query in full (``noop`` sink) with the event log
written to a fresh folder under /tmp, then reads the log (JSON lines) and
prints, per query: stages, tasks, input bytes, shuffle bytes written/read,
spill, and the largest task's share of its stage's shuffle read (a skew
indicator). No UI or server is involved.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from jobsift.plans.catalog import QUERIES  # noqa: E402


def _mb(n: float) -> str:
    return f"{n / 1e6:.1f}MB"


def summarize(log_path: str) -> dict:
    """job group -> metrics summed over its tasks."""
    stage_group: dict = {}
    job_group: dict = {}
    per_group = defaultdict(lambda: defaultdict(float))
    stage_reads = defaultdict(list)
    files = [log_path]
    if os.path.isdir(log_path):  # rolling event log: events_<n>_<app> parts
        files = sorted(glob.glob(os.path.join(log_path, "events_*")),
                       key=lambda p: int(os.path.basename(p).split("_")[1]))
    for part in files:
        with open(part, encoding="utf-8") as f:
            lines = f.readlines()
        for line in lines:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                group = props.get("spark.jobGroup.id")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                group = stage_group.get(ev["Stage ID"])
                if group is None:
                    continue
                m = ev.get("Task Metrics") or {}
                g = per_group[group]
                g["tasks"] += 1
                g["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                sw = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                g["shuffle_write"] += sw
                g["shuffle_read"] += read
                g["spill"] += m.get("Disk Bytes Spilled", 0)
                stage_reads[(group, ev["Stage ID"])].append(read)
    out = {}
    for group, g in per_group.items():
        worst = 0.0
        for (grp, _), reads in stage_reads.items():
            total = sum(reads)
            if grp == group and total > 0 and len(reads) > 1:
                worst = max(worst, max(reads) / total)
        stages = {sid for (grp, sid) in stage_reads if grp == group}
        out[group] = dict(g, stages=len(stages), max_task_share=worst)
    return out


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="jobsift-eventlog-")
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = a.names or sorted(QUERIES)
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, a.sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    log = glob.glob(os.path.join(log_dir, "*"))[0]
    stats = summarize(log)
    print(f"{'query':32} {'stages':>6} {'tasks':>6} {'input':>9} {'shuf.w':>9} {'shuf.r':>9} {'spill':>8} {'max task':>8}")
    for name in names:
        s = stats.get(name)
        if not s:
            continue
        print(f"{name:32} {s['stages']:>6} {int(s['tasks']):>6} {_mb(s['input']):>9} {_mb(s['shuffle_write']):>9} "
              f"{_mb(s['shuffle_read']):>9} {_mb(s['spill']):>8} {s['max_task_share']:>8.2f}")
    print(f"event log: {log}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
