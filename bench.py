"""Per-query wall time of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's full plan is executed with the ``noop`` sink (every row is
produced, nothing is collected).  Before timing, the same queries run once
on the smallest test tables to warm up the JVM (class loading, JIT) so the
numbers are steady-state query times.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortkit.plans import catalog  # noqa: E402
from cohortkit.session import get_session  # noqa: E402

HEADLINE = ["flagship", "J02", "A03", "W01", "I01", "A01", "A02", "A14", "A15", "R01", "R02", "R03", "R04",
            "R07", "D01", "D04", "D05", "I04", "F10", "temporal_all", "T01", "O07", "E03", "E04", "E05", "U01",
            "M01", "M02"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", max(8, cpus * 2), local_memory="16g")
    qs = catalog.queries()
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in names:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))


if __name__ == "__main__":
    main()
