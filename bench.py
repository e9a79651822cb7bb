"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the table folder, BENCH_CPUS (default 8) the
number of local threads. Each query runs once after a warm-up query; its whole result is
computed (noop sink). The time includes building the query, which for a few queries runs
jobs of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pressloom.catalog import load_all
from pressloom.catalog.base import REGISTRY, Tables
from pressloom.session import build_session

HEADLINE = [
    "category_distribution", "concept_category_matrix", "source_specialization", "top_sources",
    "best_concepts", "merge_changed", "merge_dimension", "replace_links", "upsert_articles",
    "normalize_articles", "article_load_metrics", "fold_run_ledger", "assign_nth_run",
    "discover_events", "freshness_filter", "shared_concepts", "multi_signal_links", "v_heatmap",
    "heatmap_asymmetry", "coverage_omissions", "enriched_headlines", "topic_rollup",
    "assign_cycles", "scan_article_csv",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    tables = Tables(spark, folder)
    REGISTRY["articles_per_run"].build(tables).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        start = time.perf_counter()
        REGISTRY[name].build(tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
