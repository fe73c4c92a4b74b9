"""Captured responses, attempt logs and seeds in their canonical schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.functions.urls import netloc, normalize_url
from pagegraph.operators.keys import one_of_each


def _or_default(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def read_responses(pages: DataFrame, final_as_given: bool = False) -> DataFrame:
    """Any page table with ``html`` and a ``requested_url`` or ``url`` as responses.

    ``requested_url`` is made canonical; ``status`` and ``final_url`` are added where
    they lack, the latter as the canonical URL, or the given one with
    ``final_as_given`` (posts are reported as asked for). Other columns pass through.
    A URL without valid host has NULL for ``requested_url``, so no crawl reaches its
    row. What ``resolve_attempts`` returns is such a table.
    """
    given = "requested_url" if "requested_url" in pages.columns else "url"
    known = ("url", "html", "status", "final_url", "requested_url")
    extra = [c for c in pages.columns if c not in known]
    # Two steps, so that the canonical form is worked out once.
    named = pages.select(
        *extra,
        normalize_url(given).alias("requested_url"),
        F.col(given).alias("_given"),
        _or_default(pages, "status", F.lit(200)).cast("int").alias("status"),
        _or_default(pages, "final_url", F.lit(None).cast("string")).alias("final_url"),
        "html",
    )
    default = F.col("_given" if final_as_given else "requested_url")
    return named.withColumn("final_url", F.coalesce("final_url", default)).drop("_given")


ATTEMPT_COLUMNS = {
    "url": "string",
    "attempt": "int",
    "status": "int",
    "final_url": "string",
    "content_type": "string",
    "body": "string",
    "error": "string",
}


def read_attempts(log: DataFrame, distinct: bool = False) -> DataFrame:
    """Fetch log, one row per (url, attempt), cast to the attempt schema.

    ``distinct`` is for logs delivered more than once: it keeps one row of each
    (url, attempt), the least by a hash of the row. Keys alone are grouped; bodies of
    attempts that are there once stay where they are.
    """
    missing = set(ATTEMPT_COLUMNS) - set(log.columns)
    if missing:
        raise ValueError(f"attempt log lacks {sorted(missing)}")
    attempts = log.select(*[F.col(name).cast(kind).alias(name) for name, kind in ATTEMPT_COLUMNS.items()])
    return one_of_each(attempts, ["url", "attempt"]) if distinct else attempts


def read_seeds(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct canonical seeds and their hosts."""
    # Through a generator: the filter is not moved below a ``distinct`` of ``df``, where
    # the canonical form would be worked out for every row.
    seeds = df.select(F.explode(F.array(normalize_url(url_col))).alias("seed")).filter(F.col("seed").isNotNull()).distinct()
    return seeds.withColumn("seed_netloc", netloc("seed"))
