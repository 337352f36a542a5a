"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run $BENCH_RUNS times (once by default) in a session that has run one query before; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from plumbline.plans.queries import QUERIES
from plumbline.session import local_session

HEADLINE = (
    "profile_dirty",
    "profile_lineitem",
    "missing_by_column",
    "co_missing",
    "type_contamination",
    "date_contamination",
    "duplicate_columns",
    "redundant_pairs",
    "mixed_formats",
    "case_variants",
    "code_label_lineitem",
    "period_mismatches",
    "exact_duplicates",
    "duplicate_texts",
    "near_duplicate_rows",
    "dedup",
    "normalize_dates",
    "canonical_case",
    "outliers_events",
    "outliers_lineitem",
    "rare_categories",
    "median_impute",
    "schema_fix",
    "document_numbers",
    "consistency_fix",
    "reliability_score",
    "apply_suggestions",
    "pipeline_table",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    times: dict[str, float] = {}

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("missing_by_column")
    for name in HEADLINE:
        times[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
