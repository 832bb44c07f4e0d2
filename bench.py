"""Time the registered queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; names given as arguments
restrict the run.  Each query is run in full (noop sink), best of BENCH_RUNS.
"""

import json
import os
import sys
import time

from pagelathe.session import local_session
from workload.queries import QUERIES


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    # Start the JVM code paths and the Python workers outside the timings.
    for name in ("kept_chunks_per_language", "model_embed"):
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        spent = []
        for _ in range(runs):
            at = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - at)
        times[name] = round(min(spent), 3)
        print(f"{name:28} {times[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
