"""Summarise the final (adaptive) physical plans of registered queries.

Usage: python tools/plan_summary.py [sf_dir] [name-substring ...]
Prints, per query, the count of each physical operator of interest after the
query has run (so adaptive decisions - broadcast, coalescing, skew splits -
are shown), plus the scans' pushed filters.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorebook.plans.queries import queries  # noqa: E402
from scorebook.session import build_session  # noqa: E402

OPS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
       "Window", "WindowGroupLimit", "Expand", "Generate", "BatchEvalPython",
       "ArrowEvalPython", "Exchange hashpartitioning", "Exchange rangepartitioning",
       "Exchange SinglePartition", "Exchange RoundRobinPartitioning", "BroadcastExchange",
       "ReusedExchange", "AQEShuffleRead", "FileScan parquet", "Scan ExistingRDD"]


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = collections.Counter()
    for op in OPS:
        counts[op] = len(re.findall(re.escape(op), plan))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
    return {k: v for k, v in counts.items() if v}, pushed


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    filt = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    for name, fn in queries().items():
        if filt and not any(f in name for f in filt):
            continue
        counts, pushed = summarise(fn(spark, sf_dir))
        ops = ", ".join(f"{k} {v}" for k, v in counts.items())
        print(f"| {name} | {ops} | {'; '.join(pushed) or '-'} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
