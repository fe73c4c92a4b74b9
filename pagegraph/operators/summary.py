"""Totals over crawl, scrape and post rows of mixed NDJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.functions.variants import integer_of, list_size, text_of, truthy_json

# Row kinds, and report lines in their order.
SCRAPE_KINDS = ("email", "offsite_link", "image")
POST_KIND = "instagram_post"
REPORT_LINES = {
    "total_rows": "Total rows",
    "unique_urls": "Unique URLs",
    "status_2xx": "2xx statuses",
    "status_3xx": "3xx statuses",
    "status_4xx": "4xx statuses",
    "status_5xx": "5xx statuses",
    "total_internal_links": "Total internal links",
    "total_external_links": "Total external links",
    "total_emails": "Total emails",
    "total_images": "Total images",
}
COUNTERS = tuple(name for name in REPORT_LINES if name != "unique_urls")


def row_counts(rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """What each row adds to every total, and the URL it counts under."""
    # A step of its own: several totals ask for them, and a condition would read them again.
    scraped = F.coalesce(F.col("_kind").isin(*SCRAPE_KINDS), F.lit(False))
    rows = rows.select(*keys, "v", text_of(F.col("v"), "kind").alias("_kind"))
    rows = rows.withColumn("_status", F.when(~scraped, integer_of(F.col("v"), "status")))
    v, kind, status = F.col("v"), F.col("_kind"), F.col("_status")

    def has_status(hundreds: int) -> Column:
        return (~scraped & status.between(hundreds * 100, hundreds * 100 + 99)).cast("bigint")

    def total(scrape_kind: str, crawled: Column) -> Column:
        found = (kind == scrape_kind) & truthy_json(v, "value").isNotNull()
        return F.coalesce(F.when(scraped, found.cast("bigint")).otherwise(crawled), F.lit(0)).cast("bigint")

    internal = F.coalesce(
        list_size(v, "internal_links"), integer_of(v, "n_internal_links"), list_size(v, "links"), F.lit(0)
    )
    post_image = ((kind == POST_KIND) & truthy_json(v, "image_url").isNotNull()).cast("bigint")
    images = F.coalesce(list_size(v, "images"), F.lit(0)) + F.coalesce(post_image, F.lit(0))
    return rows.select(
        *keys,
        F.when(scraped, truthy_json(v, "source_url")).otherwise(truthy_json(v, "url")).alias("counted_url"),
        F.lit(1).cast("bigint").alias("total_rows"),
        *[F.coalesce(has_status(n), F.lit(0)).alias(f"status_{n}xx") for n in (2, 3, 4, 5)],
        F.when(scraped, F.lit(0)).otherwise(internal).cast("bigint").alias("total_internal_links"),
        total("offsite_link", list_size(v, "external_links")).alias("total_external_links"),
        total("email", list_size(v, "emails")).alias("total_emails"),
        total("image", images).alias("total_images"),
    )


def counter_sums() -> dict[str, Column]:
    return {name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in COUNTERS}


def summarize(rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """All ten totals in one pass: one row, or one per combination of ``keys``.

    Rows are combined per URL before the shuffle, so an often repeated URL costs
    one row per task.
    """
    sums = counter_sums() | {"unique_urls": F.count_distinct("counted_url").alias("unique_urls")}
    counts = row_counts(rows, keys)
    return counts.groupBy(*keys).agg(*[sums[name] for name in REPORT_LINES])


def summary_report(summary: DataFrame) -> DataFrame:
    """A summary as ten labelled lines: ``ordinal, label, value``."""
    entries = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(label).alias("label"), F.col(name).alias("value"))
        for i, (name, label) in enumerate(REPORT_LINES.items(), start=1)
    ]
    return summary.select(F.inline(F.array(*entries)))
