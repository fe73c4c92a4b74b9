"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs whole into the noop sink; one small query runs first so that
starting the JVM and the Python workers is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from pagegraph.plans.registry import QUERIES
from pagegraph.session import recommended

HEADLINE = [
    "page_title",
    "page_links",
    "page_profile_counts",
    "page_emails",
    "page_description",
    "url_normalize",
    "url_dedupe",
    "text_emails",
    "emails_first_seen",
    "bfs_levels",
    "bfs_budget",
    "crawl_visits",
    "crawl_rows",
    "crawl_shops",
    "crawl_shops_budget",
    "scrape_offsite",
    "scrape_emails",
    "scrape_shop_images",
    "summary_crawl",
    "summary_mixed",
    "resolve_attempts",
    "post_metadata",
    "stream_page_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pagegraph-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
    )
    spark = recommended(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["page_links"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
