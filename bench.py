"""Bench: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query runs to completion through the ``noop`` sink (the whole plan executes,
nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from volpanel.plans import queries as q  # noqa: E402
from volpanel.session import local_session  # noqa: E402

HEADLINE = [
    "features_clean",
    "features_v3_calendar",
    "walk_forward_linear",
    "walk_forward_predictions",
    "dashboard",
    "score_requests",
    "forecast_latest",
    "garch_grid",
    "walk_forward_board",
    "final_model",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = q.REGISTRY[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    spark.catalog.clearCache()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in q.REGISTRY]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="volpanel-bench")
    # warm-up, not timed: JIT and codegen caches, on the smallest tables (not the bench data)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for n in names:
            q.REGISTRY[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
    times = {n: round(run(spark, n, sf_dir), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
