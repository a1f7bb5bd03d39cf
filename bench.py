"""Bench: wall time of the headline queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (every row computed, nothing collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickwise.queries import queries  # noqa: E402
from clickwise.session import local_session  # noqa: E402

HEADLINE = ["crossdomain_features", "gap_multi_key", "label_encode", "auc_exact", "kfold_exact", "parity_run",
            "ctr_features", "cv_oof"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, max(cpus, 8), "clickwise-bench")
    qs = queries()
    # warm the JVM (class loading, codegen caches) on the smallest query
    qs["scan_ads"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
