"""Bench: headline queries over the driver's tables, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row computed,
nothing collected to the driver); ``run_write`` also times the real partitioned
Parquet write of the flagship output into a fresh scratch folder. Every query
runs ``BENCH_REPEATS`` times (default 2) from a cleared cache, and then once cold:
inputs and plans are built anew as well, as in a session's first query. ``queries``
holds the best time of each, ``cold_queries`` the cold one.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "daily_conversions",
    "daily_conversions_20key",
    "baseline_by_day",
    "attribution_winner",
    "attribution_candidates",
    "incremental_rows",
    "stage_counts",
    "enrich_dims",
)


def forget_plans(spark) -> None:
    """Drop the inputs and stages that the registered queries share within a session."""
    for kept in ("_adlift_sources", "_adlift_stages"):
        spark.__dict__.pop(kept, None)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from adlift.config import fixture_config
    from adlift.plans import daily
    from adlift.queries import QUERIES
    from adlift.session import local_session
    from adlift.sources import fixtures

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="adlift-bench")
    # Warm the JVM (class loading, JIT of the generated code) once, outside the
    # timings: the flagship plan over the smallest tables when they are present.
    for warm in ("sf0.001", "sf0.01"):
        warm_dir = os.path.join(os.path.dirname(sf_dir), warm)
        if os.path.isdir(warm_dir) and warm_dir != sf_dir:
            QUERIES["daily_conversions"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()

    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    runs: dict[str, list[float]] = {}

    def timed(name, action):
        # No run may reuse another's data.
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        out = action()
        runs.setdefault(name, []).append(round(time.perf_counter() - t0, 3))
        return out

    scratch = tempfile.mkdtemp(prefix="adlift-bench-")
    seen = {}
    for i in range(repeats):
        for name in HEADLINE:
            timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        seen = timed("run_write", lambda: daily.run(
            spark, fixtures.load(spark, sf_dir), fixture_config(), f"{scratch}/daily_conversions_{i}"))
    times = {name: min(t) for name, t in runs.items()}
    first = {name: t[0] for name, t in runs.items()}

    cold = {}
    for name in HEADLINE:
        forget_plans(spark)
        runs.clear()
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        cold[name] = runs[name][0]
    cold["run_write"] = first["run_write"]  # builds its own inputs and plan every time

    extra = {}
    if os.environ.get("BENCH_LOOP") == "1":
        # Comparison only: the same output the way the original job runs it, one
        # plan and one action per day from a driver-side loop.
        import datetime as dt
        cfg = fixture_config()
        src = fixtures.load(spark, sf_dir)
        t0 = time.perf_counter()
        day, rows = cfg.start, 0
        while day <= cfg.end:
            rows += daily.daily_conversions(src, cfg.with_(start=day, end=day)).count()
            day += dt.timedelta(days=1)
        extra = {"loop_daily_conversions": round(time.perf_counter() - t0, 3), "loop_rows": rows}

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "repeats": repeats,
        "first_run_total": round(sum(first.values()), 3),
        "cold_queries": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "output_groups": seen.get("groups"),
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
