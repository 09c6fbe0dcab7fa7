"""Summarise stage and task times from a Spark event log folder.

Usage: python scripts/stage_times.py <eventlog dir>
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8").splitlines()


def main(d: str) -> None:
    stages, tasks = {}, {}
    for f in glob.glob(f"{d}/**/events_*", recursive=True):
        for line in lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"], (si["Completion Time"] - si["Submission Time"]) / 1000)
            elif e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    for k, (name, n, wall) in sorted(stages.items()):
        t = tasks.get(k, [])
        print(f"stage {k:3d} tasks={n:4d} wall={wall:6.2f}s max_task={max(t) if t else 0:6.2f}s sum_tasks={sum(t):7.2f}s  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
