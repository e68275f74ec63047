"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is run to completion (a full action over its result, written to a
no-op sink) once after a warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorebook.plans.queries import queries  # noqa: E402
from scorebook.session import build_session  # noqa: E402

HEADLINE = [
    "q41_match_summary_assembly",
    "q17_win_count_mart",
    "q19_batting_mart_with_styles",
    "q21_bowling_mart",
    "q33_factless_match_fact",
    "q22_surname_resolution",
    "q30_dismissal_parse",
    "q24_insert_only_upsert",
    "q04_load_gate_quarantine",
    "q38_null_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(f"local[{cpus}]", app="scorebook-bench",
                          shuffle_partitions=max(8, int(cpus) * 2),
                          extra={"spark.driver.memory": "16g"})
    qs = queries()
    names = [n for n in HEADLINE if n in qs] if not only else [n for n in qs if any(o in n for o in only)]
    # warm-up: JIT and file listing
    spark.read.parquet(os.path.join(sf_dir, "nation.parquet")).count()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
