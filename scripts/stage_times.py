"""Summarise job and stage durations from a Spark event log folder (no UI needed).

Usage: python scripts/stage_times.py <event-log-dir> [last_n_jobs]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(path: str):
    for f in sorted(glob.glob(os.path.join(path, "events*"))):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "ignore").splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if isinstance(e, dict):
                yield e


def main() -> None:
    root = sys.argv[1]
    last = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    d = sorted(glob.glob(os.path.join(root, "*")), key=os.path.getmtime)[-1]
    jstart, jobs, stages, job_stages = {}, {}, {}, {}
    for e in events(d):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jstart[e["Job ID"]] = e["Submission Time"]
            job_stages[e["Job ID"]] = e.get("Stage IDs", [])
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]] = e["Completion Time"] - jstart[e["Job ID"]]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"], si["Completion Time"] - si["Submission Time"], si["Stage Name"][:40])
    ids = sorted(jobs)[-last:]
    t0 = jstart[ids[0]]
    for j in ids:
        st = [f"s{s}:{stages[s][0]}t/{stages[s][1]}ms" for s in job_stages[j] if s in stages]
        print(f"job {j:3d} +{(jstart[j] - t0) / 1000:6.2f}s {jobs[j]:6d}ms  {' '.join(st)}")


if __name__ == "__main__":
    main()
