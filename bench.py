"""Benchmark the headline queries.

Runs each registered headline query over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

Each query is fully executed with the ``noop`` sink (every row produced, no
driver collect).  ``BENCH_ALL=1`` times every registered query instead of the
headline set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pelagic.session import get_session
    from pelagic.plans import catalog

    catalog.load_all()
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = sorted(catalog.QUERIES) if os.environ.get("BENCH_ALL") else list(catalog.BENCH)

    # warm-up: JVM class loading and the parquet footers, not timed
    catalog.QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
