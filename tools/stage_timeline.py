"""Stage timeline of one query from Spark's event log (written to a fresh scratch folder).

    python tools/stage_timeline.py <query> [sf_dir] [runs]

Runs the query ``runs`` times (noop sink) and prints the last run's SQL
execution and stages: offset from the execution start, duration, tasks.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from popspark.plans import catalog  # noqa: E402
from popspark.session import local_session  # noqa: E402


def _events(path: str):
    for f in sorted(glob.glob(os.path.join(path, "*", "events_*")) + glob.glob(os.path.join(path, "events_*"))):
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard

                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main(argv):
    name = argv[1]
    sf = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    runs = int(argv[3]) if len(argv) > 3 else 3
    log_dir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    spark = local_session(8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    for _ in range(runs):
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    execs, stages = {}, []
    for e in _events(log_dir):
        ev = e["Event"]
        if ev.endswith("SparkListenerSQLExecutionStart"):
            execs[e["executionId"]] = [e["time"], None]
        elif ev.endswith("SparkListenerSQLExecutionEnd"):
            execs[e["executionId"]][1] = e["time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages.append((si["Submission Time"], si["Completion Time"], si["Number of Tasks"], si["Stage ID"]))
    last = max(execs)
    t0, t1 = execs[last]
    print(f"{name} @ {os.path.basename(sf)}: last run, SQL execution {last}, {t1 - t0} ms wall")
    print("| stage | starts at (ms) | duration (ms) | tasks |")
    print("| --- | --- | --- | --- |")
    for sub, done, tasks, sid in sorted(stages):
        if t0 <= sub <= t1:
            print(f"| {sid} | {sub - t0} | {done - sub} | {tasks} |")
    print(f"\nevent log: {log_dir}")


if __name__ == "__main__":
    main(sys.argv)
