"""Summarise a Spark event log per job description (e.g. ``bench:<query>``).

Usage: python tools/stage_times.py <event-log-file-or-dir>
Prints, per description: jobs, stages, tasks, summed executor run time and
the wall time between the first job start and the last job end.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event-log file, plain or zstd-compressed (Spark 4's default)."""
    if path.endswith(".zstd") or path.endswith(".zst"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    files = sorted(os.path.join(base, f) for base, _d, fs in os.walk(path) for f in fs
                   if not f.startswith(".")) if os.path.isdir(path) else [path]
    job_desc: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    agg = defaultdict(lambda: {"jobs": 0, "stages": set(), "tasks": 0, "run_ms": 0,
                               "start": None, "end": None})
    for f in files:
        if os.path.basename(f).startswith("appstatus"):
            continue
        for line in _lines(f):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or "-"
                    jid = ev["Job ID"]
                    job_desc[jid] = desc
                    a = agg[desc]
                    a["jobs"] += 1
                    t = ev.get("Submission Time")
                    a["start"] = t if a["start"] is None else min(a["start"], t)
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = jid
                elif kind == "SparkListenerJobEnd":
                    a = agg[job_desc.get(ev["Job ID"], "-")]
                    t = ev.get("Completion Time")
                    a["end"] = t if a["end"] is None else max(a["end"], t)
                elif kind == "SparkListenerTaskEnd":
                    sid = ev.get("Stage ID")
                    a = agg[job_desc.get(stage_job.get(sid, -1), "-")]
                    a["tasks"] += 1
                    a["stages"].add(sid)
                    a["run_ms"] += (ev.get("Task Metrics") or {}).get("Executor Run Time", 0)
    print(f"{'description':45s} {'jobs':>5s} {'stages':>6s} {'tasks':>6s} {'run_s':>8s} {'wall_s':>8s}")
    for desc, a in sorted(agg.items()):
        wall = (a["end"] - a["start"]) / 1000 if a["start"] and a["end"] else 0.0
        print(f"{desc[:45]:45s} {a['jobs']:5d} {len(a['stages']):6d} {a['tasks']:6d} "
              f"{a['run_ms'] / 1000:8.2f} {wall:8.2f}")


if __name__ == "__main__":
    main()
