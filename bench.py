"""Benchmark the headline queries.

Runs each query on the tables in ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.

Every query is fully materialized with the ``noop`` writer (all columns, all
rows), so nothing is pruned away the way a bare ``count()`` could be.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from verity.plans.catalog import QUERIES  # noqa: E402
from verity.session import local_session  # noqa: E402

HEADLINE = [
    "score_pairs",
    "evaluate_pairs",
    "score_conversation_pairs",
    "attempt_decisions",
    "regeneration_loop",
    "results_upsert",
    "results_merge",
    "global_metrics",
    "reuse_lookup",
    "route_questions",
    "reuse_ttl_hits",
    "reuse_distance",
    "threshold_sweep",
    "latency_summary",
    "validated_union",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]] or HEADLINE
    spark = local_session(cpus, app="verity-bench")
    # Warm the JVM (code generation, regex JIT, parquet reader) on a smaller
    # scale factor, outside the timings: a cold JIT doubles the first
    # text-heavy query.  No result or cache is shared with the timed runs.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    for name in ("score_pairs", "attempt_decisions", "reuse_ttl_hits", "status_counts"):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
