"""Bench: wall time of the headline queries on local[$BENCH_CPUS].

``q_pipeline`` and ``q_scd2_product`` start from the raw parquet for every run
(key assignment, both merges, gates and all writes are part of the time).  The
other queries read the tables at rest that the warehouse consists of, as their
users do: reports and the as-of join read the warehouse stored by the
preceding ``q_pipeline``, the upsert its stored source and target.  Every
query runs to completion with the ``noop`` sink (nothing is collected).
``$BENCH_WARMUP`` warm-up passes (default 2: the JVM keeps compiling for
several runs), then the median of ``$BENCH_RUNS`` runs.

Prints one JSON line:
{"metric": "headline_stored_tables_total_median", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import gc
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "q_pipeline",
    "q_monthly_revenue",
    "q_product_revenue_rank",
    "q_scd2_product",
    "q_asof_product_join",
    "q_upsert_fact",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from sparkmart.plans import queries as registry
    from sparkmart.session import build_session, release_scratch

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)), app_name="sparkmart-bench")

    def run_once(name: str) -> float:
        sc = registry.scenarios(spark, sf_dir)
        if name == "q_pipeline":  # everything anew
            registry._CACHE.clear()
            release_scratch(spark)
        elif name == "q_scd2_product":  # the merge anew
            sc.__dict__.pop("scd2_result", None)
        elif name == "q_upsert_fact":  # the tables at rest, outside the clock
            sc.sync_source_fact, sc.sync_target_fact
        # Drop the previous run's Python handles so the JVM can release their
        # plans, broadcasts and checkpoint files before the clock starts.
        gc.collect()
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    for _ in range(warmup):  # warm-up passes: JIT compilation, file listing caches
        for name in names:
            run_once(name)
    timings = {name: [] for name in names}
    for _ in range(runs):
        for name in names:
            timings[name].append(run_once(name))
    medians = {name: round(statistics.median(ts), 3) for name, ts in timings.items()}
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_stored_tables_total_median",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": cpus,
                "runs": runs,
                "warmup": warmup,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
