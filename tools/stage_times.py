"""Print job and stage times from a Spark event log folder.

Usage: python tools/stage_times.py <event-log-dir> [since_ms]
Reads every events file under the folder (rolling v2 logs included, written
uncompressed: spark.eventLog.compress=false).
"""

from __future__ import annotations

import glob
import json
import os
import sys


def events(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)
                       + glob.glob(os.path.join(folder, "local-*"))):
        with open(path) as fh:
            for line in fh:
                yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    since = int(sys.argv[2]) if len(sys.argv) > 2 else 0
    for e in events(folder):
        kind = e["Event"]
        if kind == "SparkListenerJobStart" and e["Submission Time"] >= since:
            print(f"job {e['Job ID']:>4} start +{e['Submission Time'] - since} ms stages {e['Stage IDs']}")
        elif kind == "SparkListenerStageCompleted":
            s = e["Stage Info"]
            if s.get("Submission Time", 0) >= since:
                dur = s["Completion Time"] - s["Submission Time"]
                print(f"  stage {s['Stage ID']:>4} tasks {s['Number of Tasks']:>4} {dur:>6} ms  {s['Stage Name'][:70]}")


if __name__ == "__main__":
    main()
