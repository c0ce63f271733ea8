"""Print a compact physical-plan summary of the headline queries.

usage: python scripts/plans.py [sf_dir] [name ...]

For each query: the executed (adaptive) plan's operator counts and, per scan,
the pushed filters, partition filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import catalog  # noqa: E402
from wayfare.session import build_session  # noqa: E402

DEFAULT = ["arrivals_by_city", "arrivals_by_city_joined", "conform", "immigration", "airports",
           "city", "r1", "r2", "r3", "r5", "period_pruned_read", "weather_month"]
OPS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "Exchange", "BroadcastExchange", "HashAggregate", "SortAggregate",
       "Sort", "Window", "BatchEvalPython", "ArrowEvalPython", "Generate", "Expand"]


def summarize(name, df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = Counter()
    for op in OPS:
        counts[op] = len(re.findall(rf"\b{op}\b", plan))
    # "\bExchange\b" already excludes BroadcastExchange: Exchange counts shuffles only
    print(f"== {name}: " + ", ".join(f"{k}={v}" for k, v in counts.items() if v))
    for line in plan.splitlines():
        if "FileScan" in line or "Scan parquet" in line or "Scan csv" in line:
            loc = re.search(r"Location: \w+(?:\([^)]*\))? ?\[([^\]]*)\]", line)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            part = re.search(r"PartitionFilters: (\[[^\]]*\])", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            table = os.path.basename(loc.group(1).split(",")[0].rstrip("/")) if loc else "?"
            print(f"   scan {table}: pushed={pushed.group(1) if pushed else '-'} "
                  f"partition={part.group(1) if part else '-'} cols={schema.group(1) if schema else '-'}")


def main():
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or DEFAULT
    spark = build_session("local[8]", 16)
    for name in names:
        summarize(name, catalog.QUERIES[name](spark, sf))


if __name__ == "__main__":
    main()
