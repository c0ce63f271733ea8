"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.  Every query is forced to full
evaluation with the ``noop`` sink (no driver collect); the monthly run and the
backfill write their tables below the session's checkpoint folder.

JVM warm-up (class loading, JIT, code generation) runs the flagship once on the
smallest test tables when they exist; plans and table reads are keyed by data
folder, so nothing computed there is reused by the measured queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalog  # noqa: E402
from wayfare.session import build_session  # noqa: E402

HEADLINE = [
    "arrivals_by_city",          # flagship G12, facts joined on (cicid, i94dt)
    "arrivals_by_city_joined",   # G12 from the facts as a run stores them
    "conform",                   # G9
    "immigrant", "immigration",  # G10, G11
    "weather_month", "airports", "city", "us_ports",
    "stored_mart",               # the mart that the reports read, written once
    "r1", "r2", "r3", "r4", "r5",
    "period_source",             # A4: month files written, then one multi-month scan
    "table_scan",                # B3 + A5
    "run_month",                 # H5: whole monthly run into storage
    "backfill",                  # H6: all months as one run
]

# Measured when named (python bench.py --more): features without an earlier baseline.
MORE = ["rejected_records", "publish_cycle", "asof_temperature", "presence_by_state", "stored_mart", "sketch_estimates",
        "reports_by_parts", "top_origins", "report_totals", "delivery_changes", "event_windows"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = MORE if sys.argv[1:] == ["--more"] else sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, int(cpus) * 2))
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        catalog.arrivals_by_city(spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        catalog.us_state(spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings, errors = {}, {}
    for name in only:
        t0 = time.perf_counter()
        try:
            df = catalog.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as ex:  # noqa: BLE001 - report and keep measuring the rest
            timings[name] = None
            errors[name] = f"{type(ex).__name__}: {str(ex)[:300]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_wall_time",
           "value": round(sum(v for v in timings.values() if v is not None), 3),
           "unit": "sec", "queries": timings, "sf": sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
