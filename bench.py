"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose the data and the cores. Each query
runs BENCH_RUNS times (default 3) into the no-op sink; the median counts, after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.queries import QUERIES  # noqa: E402
from wirelake.session import build_session  # noqa: E402

HEADLINE = [
    "url_rules", "serp_parse", "extract_chain", "extract_errors", "join_content", "sentiment", "keywords_topk", "summary_topk",
    "latest_enrichment", "earliest_article", "need_enrichment_version", "executed_queries", "executed_by_range", "company_cost",
    "collection_plan", "daily_collection", "coverage", "recent_runs", "collection_report", "stream_dedup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("url_rules")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    pages = spark.read.parquet(f"{folder}/pages.parquet").count()
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": cores, "articles_per_s": round(pages / seconds["extract_chain"], 1),
    }))


if __name__ == "__main__":
    main()
