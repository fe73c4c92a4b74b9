"""Profiles, scrape rows and summaries of pages as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.operators.extract import profile_pages
from pagegraph.operators.shape import TARGETS
from pagegraph.operators.summary import COUNTERS, REPORT_LINES, counter_sums, row_counts


def stream_profiles(responses: DataFrame, seed_netloc: str, keep: Sequence[str] = ()) -> DataFrame:
    """Profile of each arriving page; without state, append mode."""
    return profile_pages(responses, seed_netloc, keep)


def stream_values(profiles: DataFrame, target: str, *keep: str) -> DataFrame:
    """One row per arriving page and value: ``kind, value, source_url`` and ``keep``,
    say the column that orders pages."""
    kind, column = TARGETS[target]
    value = F.explode(column).alias("value")
    return profiles.select(F.lit(kind).alias("kind"), value, F.col("url").alias("source_url"), *keep)


def stream_scrape(profiles: DataFrame, target: str, event_time: str | None = None, within: str | None = None) -> DataFrame:
    """Each value once, when it first arrives; append mode.

    Which page of a batch a value is credited to is left open; ``stream_first_sources``
    settles it. Values are remembered for good. With ``event_time`` and ``within`` they are
    forgotten after that delay, which bounds the state and lets a value return.
    """
    if event_time is None:
        return stream_values(profiles, target).dropDuplicates(["kind", "value"])
    kind, column = TARGETS[target]
    timed = profiles.withWatermark(event_time, within).select(
        event_time, F.lit(kind).alias("kind"), F.explode(column).alias("value"), F.col("url").alias("source_url")
    )
    return timed.dropDuplicatesWithinWatermark(["kind", "value"])


def stream_first_sources(values: DataFrame, order: str) -> DataFrame:
    """Each value once, when it first arrives, with its page: ``kind, value, source_url``; update mode.

    That is the first by ``order`` of the batch in which the value first arrives, and it stays so.
    A value's state is one keyed row, so a batch costs what it brings, whatever came before.
    ``values`` comes from ``stream_values`` and keeps ``order``.
    """
    now = F.current_timestamp()  # the time of the batch
    met = values.withColumn("met", now).groupBy("kind", "value").agg(
        F.min_by("source_url", order).alias("source_url"), F.min("met").alias("since"), F.max("met").alias("until")
    )
    # Only in its first batch has a value met no time but the present one.
    return met.filter((F.col("since") == now) & (F.col("until") == now)).select("kind", "value", "source_url")


FIRST_SOURCES = T.StructType([T.StructField(name, T.StringType()) for name in ("kind", "value", "source_url")])


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps each batch's rows in a folder of its own, so
    that a batch run again replaces what it wrote, and reads nothing back."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType = FIRST_SOURCES) -> DataFrame:
    """What ``write_batches`` has written."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path).drop("batch")


def stream_counters(rows: DataFrame) -> DataFrame:
    """Nine of the totals kept running, unique URLs estimated; complete mode."""
    estimate = F.approx_count_distinct("counted_url").alias("approx_unique_urls")
    return row_counts(rows).groupBy().agg(*counter_sums().values(), estimate)


def stream_unique_urls(rows: DataFrame) -> DataFrame:
    """Exact number of unique URLs; complete mode, in a query of its own."""
    urls = row_counts(rows).select("counted_url").filter(F.col("counted_url").isNotNull())
    return urls.dropDuplicates(["counted_url"]).groupBy().agg(F.count(F.lit(1)).alias("unique_urls"))


def stream_summary(rows: DataFrame) -> DataFrame:
    """All ten totals kept running, exact, in one query; complete mode.

    URLs that arrive for the first time pass a keyed state and count one each; the
    totals behind take them together with what every row adds. A URL costs one row of
    state, a batch what it brings.
    """
    counts = row_counts(rows)
    first = counts.select("counted_url").filter(F.col("counted_url").isNotNull()).dropDuplicates(["counted_url"])
    nothing = [F.lit(0).cast("bigint").alias(name) for name in COUNTERS]
    added = counts.select(*COUNTERS, F.lit(0).cast("bigint").alias("unique_urls"))
    added = added.unionByName(first.select(*nothing, F.lit(1).cast("bigint").alias("unique_urls")))
    sums = counter_sums() | {"unique_urls": F.coalesce(F.sum("unique_urls"), F.lit(0)).alias("unique_urls")}
    return added.groupBy().agg(*[sums[name] for name in REPORT_LINES])
