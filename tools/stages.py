"""Shuffle and task summary of queries from Spark's event log.

    python tools/stages.py /root/testdata/sf0.1 flagship J02 ...

Writes the event log to a fresh scratch folder (no web UI), then sums per
query: jobs, stages, tasks, input bytes, shuffle bytes written and read.
"""

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortkit.plans import catalog  # noqa: E402
from cohortkit.session import get_session  # noqa: E402


def main():
    sf, names = sys.argv[1], sys.argv[2:]
    logdir = tempfile.mkdtemp(prefix="ck-events-")
    spark = get_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false"})
    qs = catalog.queries()
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        qs[n](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    stats = {n: dict(jobs=0, stages=0, tasks=0, input_mb=0.0, shuffle_write_mb=0.0, shuffle_read_mb=0.0) for n in names}
    job_group, stage_group = {}, {}
    files = [f for f in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(f)]
    for f in sorted(files):
        if f.endswith((".zstd", ".lz4", ".snappy")):
            continue
        for line in open(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                if g in stats:
                    stats[g]["jobs"] += 1
                    for s in e.get("Stage IDs", []):
                        stage_group[s] = g
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                g = stage_group.get(info["Stage ID"])
                if g is None:
                    continue
                st = stats[g]
                st["stages"] += 1
                st["tasks"] += info.get("Number of Tasks", 0)
                for acc in info.get("Accumulables", []):
                    name, val = acc.get("Name"), acc.get("Value")
                    try:
                        val = float(val)
                    except (TypeError, ValueError):
                        continue
                    if name == "internal.metrics.input.bytesRead":
                        st["input_mb"] += val / 2 ** 20
                    elif name == "internal.metrics.shuffle.write.bytesWritten":
                        st["shuffle_write_mb"] += val / 2 ** 20
                    elif name in ("internal.metrics.shuffle.read.remoteBytesRead",
                                  "internal.metrics.shuffle.read.localBytesRead"):
                        st["shuffle_read_mb"] += val / 2 ** 20
    for n in names:
        s = stats[n]
        print(f"{n:14s} jobs={s['jobs']:3d} stages={s['stages']:3d} tasks={s['tasks']:5d} input={s['input_mb']:8.1f}MB "
              f"shuffle_write={s['shuffle_write_mb']:8.1f}MB shuffle_read={s['shuffle_read_mb']:8.1f}MB")


if __name__ == "__main__":
    main()
