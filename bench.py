"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. All queries run
once to warm up the JVM; then each is timed, best of a few, from building its
plan to having produced every output row (a no-op sink, so that no result
travels to Python). Nothing is cached between runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyward.catalog import REGISTRY  # noqa: E402
from tallyward.session import local_session  # noqa: E402

HEADLINE = (
    "numerator_cohort", "denominator_cohort", "measure_summary", "case_ascertainment",
    "index_event", "emergency_events", "care_history", "interval_join_followup",
    "interval_join_lookback", "earliest_per_key_ties", "null_aware_anti", "or_over_outer_dims",
    "inner_join_chain", "dual_role_location", "stage_strata_counts",
    "stage_distribution_any_excl", "distinct_project",
)
REPEATS = 2


def seconds(spark, name: str, directory: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].build(spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "tallyward-bench")
    names = sys.argv[1:] or HEADLINE
    for name in names:
        seconds(spark, name, directory)
    times = {}
    for name in names:
        times[name] = round(min(seconds(spark, name, directory) for _ in range(REPEATS)), 3)
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(directory.rstrip("/")),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
