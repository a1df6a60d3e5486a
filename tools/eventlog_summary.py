"""Summarise a Spark event log by stage: task time, shuffle bytes, result bytes.

Usage: python tools/eventlog_summary.py <event-log folder> [job group]

Write the log with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<fresh scratch folder>`` (no UI needed). With a job
group, only stages of jobs started under ``sc.setJobGroup(group, ...)``
count. Reads plain and zstd-compressed logs.
"""

from __future__ import annotations

import collections
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode("utf-8", "replace").splitlines():
        try:
            yield json.loads(line)
        except ValueError:
            continue


def summarise(folder: str, group: str | None = None):
    files = []
    for root, _, names in os.walk(folder):
        files += [os.path.join(root, n) for n in names if not n.startswith(".") and "appstatus" not in n]
    stage_name, stage_group = {}, {}
    # tasks, run ms, shuffle write bytes, shuffle read bytes, result bytes
    agg = collections.defaultdict(lambda: [0, 0, 0, 0, 0])
    for path in sorted(files):
        for e in _lines(path):
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = g
            elif ev == "SparkListenerStageSubmitted":
                info = e["Stage Info"]
                stage_name[info["Stage ID"]] = info["Stage Name"].split(" at ")[0]
            elif ev == "SparkListenerTaskEnd":
                sid = e["Stage ID"]
                if group is not None and stage_group.get(sid) != group:
                    continue
                m = e.get("Task Metrics") or {}
                a = agg[stage_name.get(sid, "?")]
                a[0] += 1
                a[1] += m.get("Executor Run Time", 0)
                a[2] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                a[3] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                a[4] += m.get("Result Size", 0)
    return agg


def main():
    if len(sys.argv) < 2:
        print(__doc__)
        sys.exit(2)
    agg = summarise(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)
    total = sum(a[1] for a in agg.values()) or 1
    mb = 2 ** 20
    for name, a in sorted(agg.items(), key=lambda kv: -kv[1][1]):
        print(f"{name:40s} tasks={a[0]:5d} run_s={a[1] / 1000:8.1f} ({100 * a[1] / total:4.1f}%) "
              f"shuffle_w_MB={a[2] / mb:8.1f} shuffle_r_MB={a[3] / mb:8.1f} result_MB={a[4] / mb:6.1f}")
    print(f"total task run s {total / 1000:.1f}")


if __name__ == "__main__":
    main()
