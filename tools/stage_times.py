"""Summarise a Spark event log: wall time and task time per job group and
per stage, longest first.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py $BENCH_EVENT_LOG_DIR/<app-id> [top]
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event lines from a log file or a rolling event-log folder (zstd or plain)."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard
            with open(fp, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(path: str, top: int = 15) -> None:
    job_group, stage_job, stage_info = {}, {}, {}
    task_ms = defaultdict(int)
    if True:
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                group = props.get("spark.jobGroup.id", "-")
                job_group[e["Job ID"]] = group
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                stage_info[info["Stage ID"]] = (info["Stage Name"][:60], info["Number of Tasks"], dur)
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                task_ms[e["Stage ID"]] += m.get("Executor Run Time", 0)
    by_group = defaultdict(lambda: [0, 0, 0])
    for sid, (name, ntasks, dur) in stage_info.items():
        g = job_group.get(stage_job.get(sid), "-")
        by_group[g][0] += dur
        by_group[g][1] += task_ms[sid]
        by_group[g][2] += 1
    print(f"{'group':<16}{'stages':>8}{'stage wall ms':>15}{'task ms':>10}")
    for g, (wall, tms, n) in sorted(by_group.items(), key=lambda kv: -kv[1][0]):
        print(f"{g:<16}{n:>8}{wall:>15}{tms:>10}")
    print(f"\n{'stage':>6} {'group':<14}{'tasks':>6}{'wall ms':>9}{'task ms':>9}  name")
    for sid, (name, ntasks, dur) in sorted(stage_info.items(), key=lambda kv: -kv[1][2])[:top]:
        print(f"{sid:>6} {job_group.get(stage_job.get(sid), '-'):<14}{ntasks:>6}{dur:>9}{task_ms[sid]:>9}  {name}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
