"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1). Each query runs to completion through Spark's
``noop`` sink (every row computed, nothing collected); the reported time
per query is the best of the repeats, after one untimed warm-up of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from payrun.plans import queries as Q  # noqa: E402
from payrun.session import local_session  # noqa: E402

HEADLINE = (
    "payment_totals",     # flagship: clean -> rates -> D1, D3, D4 -> totals
    "batch_summary",      # full D1-D16 chain + per-batch statistics
    "promote_header",     # grid -> header detection -> named rows
    "area_lookup",        # J1 lookup join
    "default_rate",       # quote snapshots R1-R7
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="payrun-bench")
    reg = Q.registry()
    reg["rows_per_batch"](spark, sf).collect()          # warm-up
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.time()
            reg[name](spark, sf).write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_name, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
