"""Benchmark the headline queries.

Runs each registered query's whole plan (as the library builds it, without
the check projection of ``queries()``) into Spark's ``noop`` sink (full
execution, no driver collect), once to warm up and once timed, on ``local[$BENCH_CPUS]``
over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1).  Prints one JSON line.
``$BENCH_EVENT_LOG`` (a folder) turns on Spark's event log for
``scripts/stage_times.py``; ``$BENCH_MATERIALIZE=1`` also times writing all
22 tables (reported apart from the headline total).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "g11_hourly_quality",
    "g12_quality_weekly",
    "g13_oee_kpis",
    "g14_cost_exposure",
    "g15_cumulative_costs",
    "g16_line_daily_metrics",
    "g17_change_alignment",
    "g19_kpi_spend_30d",
    "g22_scenarios",
    "x1_story_signals",
    "x3_message_fold",
    "d2_breach_episodes",
    "d6_reallocation",
    "t1_stream_hourly_flags",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE

    from plantlens.plans.registry import load_all
    from plantlens.session import build_session, configure

    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG")      # optional: stage/task times for scripts/stage_times.py
    if log_dir:
        os.makedirs(log_dir, exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus), extra=extra)
    configure(spark)
    registry = load_all()
    times = {}
    for key in keys:
        # The query as the library builds it; queries() adds a check
        # projection (bucketed doubles, dates as text) for the oracle only.
        fn = registry[key].build
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus), "spark": spark.version}
    if os.environ.get("BENCH_MATERIALIZE"):
        # Optional: all 22 tables written in order (silver, then gold over the
        # written silver) under the shared checkpoint folder.  Not in "value".
        import uuid

        from plantlens.plans.layers import from_test_tables, materialize
        from plantlens.session import checkpoint_dir

        base = f"{checkpoint_dir(spark).rstrip('/')}/plantlens-bench/{uuid.uuid4().hex}"
        t0 = time.perf_counter()
        materialize(from_test_tables(spark, sf_dir), base, database=f"bench_{uuid.uuid4().hex[:8]}")
        out["materialize_all_tables_sec"] = round(time.perf_counter() - t0, 3)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
