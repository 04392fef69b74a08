"""Summarise a Spark event log: the slowest stages with their task counts,
and total stage time per job description.

usage: python tools/stage_times.py <event-log file or directory> [top_n]
(write one with BENCH_EVENT_LOG=<dir> python bench.py ...; rolling logs
directories and zstd-compressed files are read as written by Spark 4)
"""

from __future__ import annotations

import io
import json
import sys
from pathlib import Path


def _lines(path: Path):
    files = sorted(path.rglob("events_*")) if path.is_dir() else [path]
    for f in files:
        if f.suffix == ".zstd":
            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as text:
                yield from text


def main() -> None:
    path = Path(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, label = [], {}
    for line in _lines(path):
        if not line.strip():
            continue
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description") or "-"
            for sid in ev.get("Stage IDs", []):
                label[sid] = desc
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start is not None and end is not None:
                stages.append(((end - start) / 1000.0, info["Stage ID"], info["Number of Tasks"],
                               info["Stage Name"].split(" at ")[0]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.1f} s of stage time in total")
    per = {}
    for secs, sid, _, _ in stages:
        per[label.get(sid, "-")] = per.get(label.get(sid, "-"), 0.0) + secs
    print("stage time per job description:")
    for desc, secs in sorted(per.items(), key=lambda x: -x[1]):
        print(f"  {secs:7.2f} s  {desc}")
    print(f"slowest {top} stages:")
    for secs, sid, tasks, name in stages[:top]:
        print(f"  {secs:7.2f} s  stage {sid:5d}  tasks {tasks:5d}  {label.get(sid, '-'):32s} {name}")


if __name__ == "__main__":
    main()
