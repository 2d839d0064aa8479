"""Headline benchmark: wall time of the five report operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each report is built from the test tables and run to completion through the
``noop`` sink (the whole plan executes, nothing is collected).  The timer
covers all a caller pays for: the jobs that run while the plan is built (size
checks of catalogues and orders) as well as the report itself; ``plan_time``
says how much of it was spent building.  One warm-up pass over all reports is
excluded; the timed value per report is the best of ``BENCH_REPEAT`` runs, and
``value`` sums them.  ``refresh`` times one whole refresh: staging and
promoting a snapshot, then building and publishing all reports from it.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skuflow.plans import inspect as PI  # noqa: E402
from skuflow.plans import pipeline  # noqa: E402
from skuflow.plans.queries import REGISTRY  # noqa: E402
from skuflow.session import build_session, scratch_path  # noqa: E402
from skuflow.sources import snapshot  # noqa: E402
from skuflow.sources.fixtures import shop_from_testdata  # noqa: E402

HEADLINE = ("retention_table", "sunset_table", "report_non_bundle", "report_only_bundle", "report_merged")


def run_once(spark, sf_dir: str, name: str) -> tuple[float, float]:
    """Seconds of building the report's plan, and of both building and running it."""
    t0 = time.perf_counter()
    df = REGISTRY[name](spark, sf_dir)
    built = time.perf_counter() - t0
    df.write.format("noop").mode("overwrite").save()
    return built, time.perf_counter() - t0


def refresh(spark, sf_dir: str) -> dict[str, float]:
    root = scratch_path(spark, "bench-refresh")
    t0 = time.perf_counter()
    snapshot.snapshot_and_promote(spark, shop_from_testdata(spark, sf_dir), f"{root}/stage")
    t1 = time.perf_counter()
    pipeline.run(spark, snapshot.read_live(spark, f"{root}/stage"), f"{root}/out")
    t2 = time.perf_counter()
    return {"stage_and_promote": round(t1 - t0, 3), "build_and_publish": round(t2 - t1, 3), "total": round(t2 - t0, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="skuflow-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="skuflow-bench-")})
    chosen = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    for name in chosen:            # warm-up: JIT, file listing
        run_once(spark, sf_dir, name)
    timings, building, exchanges = {}, {}, {}
    for name in chosen:
        built, total = min((run_once(spark, sf_dir, name) for _ in range(repeat)), key=lambda r: r[1])
        timings[name], building[name] = round(total, 3), round(built, 3)
        exchanges[name] = PI.summary(REGISTRY[name](spark, sf_dir))["distinct_shuffles"]
    whole = refresh(spark, sf_dir) if os.environ.get("BENCH_REFRESH", "1") == "1" else {}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "report_wall_seconds_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "plan_time": building,
        "distinct_shuffles": exchanges,
        "refresh": whole,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
