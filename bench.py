"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver) after one untimed warm-up
pass, then timed ``$BENCH_REPEATS`` times (default 2); the fastest run is
reported, which damps JIT and GC noise of a single JVM. Prints one JSON
line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobsift.bindings import Tables  # noqa: E402
from jobsift.plans.catalog import QUERIES  # noqa: E402
from jobsift.session import build_session, clear_scratch  # noqa: E402

HEADLINE = [
    "region_salary", "category_salary", "region_salary_by_category", "edu_distribution_by_category",
    "posting_snapshot", "posting_history", "search_grouped", "search_page", "similar_jobs",
    "user_bookmarks", "bookmark_actions", "sync_upsert", "sync_cascade", "first_wins_dedupe",
    "reject_report", "page_text", "page_records", "term_frequency", "term_top_by_lang", "skill_terms_by_category",
    "html_detail_roundtrip", "json_detail_roundtrip", "page_embedded_json", "extracted_contract",
    "stream_toggle_state", "stream_daily_users", "stream_category_counts", "stream_dedupe", "stream_upsert",
    "search_request_table", "history_incremental", "stream_category_sketches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8))
    Tables.text_partitions = cpus * 2  # the text tables are single files of one row group
    # one untimed warm-up pass: JVM start, class loading and codegen caches
    # are not query time
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeats = max(int(os.environ.get("BENCH_REPEATS", "2")), 1)
    runs = {name: [] for name in names}
    for _ in range(repeats):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - t0)
            clear_scratch(spark)
    times = {name: round(min(r), 3) for name, r in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
