"""Summarise stage and task times from a Spark event log.

Usage: python scripts/stage_times.py EVENT_LOG [top_n]
EVENT_LOG is a log file or a rolling log folder (events_*, plain or .zstd).
Prints the slowest stages with task count, stage wall time, and the max and
median task run time (a max far above the median is skew).
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys


def lines(path):
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard

            with open(fp, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(fp) as f:
                yield from f


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    tasks, stages = {}, {}
    if True:
        for line in lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerTaskEnd":
                info = e["Task Info"]
                key = (e["Stage ID"], e["Stage Attempt ID"])
                tasks.setdefault(key, []).append(info["Finish Time"] - info["Launch Time"])
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                key = (si["Stage ID"], si["Stage Attempt ID"])
                wall = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages[key] = (si["Stage Name"].split(" at ")[0], si["Number of Tasks"], wall)
    rows = []
    for key, (name, n, wall) in stages.items():
        t = tasks.get(key, [0])
        rows.append((wall, key[0], name, n, max(t), statistics.median(t)))
    rows.sort(reverse=True)
    print(f"{'stage':>6} {'tasks':>6} {'wall ms':>8} {'max ms':>7} {'median':>7}  name")
    for wall, sid, name, n, mx, med in rows[:top]:
        print(f"{sid:>6} {n:>6} {wall:>8} {mx:>7} {med:>7.0f}  {name}")
    print(f"{len(stages)} stages, {sum(len(v) for v in tasks.values())} tasks")


if __name__ == "__main__":
    main()
