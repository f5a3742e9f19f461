"""Time the headline queries and print one JSON line.

Every query first runs once on the smallest tables, so the times leave out JVM warm-up; inputs that
several queries share (stored works, preprints, landed records) are written before the clock starts.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline list)
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contract.queries import (  # noqa: E402
    QUERIES, star_works, stored_preprints, stored_raw_works, stored_works,
)
from trendloom.session import build_session  # noqa: E402

HEADLINE = (
    "trend_cards", "trend_growth", "topic_share", "topic_orgs", "topic_diffusion",
    "topic_best_works", "topic_growth", "normalize_works", "restore_text", "institutions_dedup",
    "link_id_extract", "oai_parse", "preprints_dedup", "preprint_link", "works_by_year",
    "embeddable_by_year", "filter_funnel", "completeness", "country_top", "corpus_totals",
    "dup_counts", "coverage_gap", "acceptance", "catalog_rows", "work_snippet", "facet_search",
    "facet_last_page", "sample_systematic", "sample_stratified", "sample_uniform", "embed_chunks",
    "embed", "l2_normalize", "scan_works", "sink_roundtrip", "catalog_doc", "index_doc",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = tuple(QUERIES) if wanted == "all" else tuple(wanted.split(",")) if wanted else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for prepare in (stored_works, stored_preprints, star_works, stored_raw_works):    # shared inputs, not timed
        prepare(spark, sf_dir)

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):          # compile and warm up on the smallest tables
        for name in names:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
