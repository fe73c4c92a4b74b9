"""The four jobs end to end: tables in, NDJSON or a report out.

Jobs on responses take captured pages (``read_responses``) or a log of fetch attempts
(``attempt_responses``, which has the number of retries).

Rows of several seeds carry their ``seed``; ``with_seed=False`` leaves it out,
which for a single seed gives the plain row.

A ``Counts`` given to a job has, once the job has run, what it left out: pages read and
refused and references left out of a crawl, URLs refused by an attempt log, lines rejected
of NDJSON. Nothing is read again for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagegraph.operators.counts import Counts
from pagegraph.operators.crawl import DEFAULT_MAX_PAGES, crawl
from pagegraph.operators.extract import post_metadata
from pagegraph.operators.fetchlog import DEFAULT_RETRIES, resolve_attempts
from pagegraph.operators.shape import TARGET_FACTS, TARGETS, crawl_rows, scrape
from pagegraph.operators.summary import summarize, summary_report
from pagegraph.operators.traverse import MAX_DEPTH, MIN_DEPTH
from pagegraph.session import staged
from pagegraph.sources.ndjson import read_ndjson, write_ndjson_counted, write_posts
from pagegraph.sources.responses import read_attempts, read_responses


def _checked(depth: int) -> int:
    if not MIN_DEPTH <= depth <= MAX_DEPTH:
        raise ValueError(f"depth is {MIN_DEPTH} to {MAX_DEPTH}")
    return depth


def attempt_responses(
    log: DataFrame, retries: int = DEFAULT_RETRIES, on_error: str = "quarantine", counts: Counts | None = None
) -> DataFrame:
    """A log of fetch attempts as the responses that the other jobs take."""
    return read_responses(resolve_attempts(read_attempts(log), retries, on_error, counts))


def _rows(df: DataFrame, with_seed: bool) -> DataFrame:
    return df if with_seed else df.drop("seed")


def crawl_job(
    responses: DataFrame,
    seeds: DataFrame,
    out: str,
    depth: int = MIN_DEPTH,
    max_pages: int | None = DEFAULT_MAX_PAGES,
    with_seed: bool = True,
    in_order: bool = False,
    counts: Counts | None = None,
) -> int:
    """Write the crawl rows of every seed and give their number. ``in_order``
    sorts them by seed and order of visit."""
    visits = crawl(responses, seeds, _checked(depth), max_pages, counts=counts)
    if in_order:
        visits = staged(visits, "visits").orderBy("seed", "bfs_key")
    return write_ndjson_counted(_rows(crawl_rows(visits), with_seed), out)


def scrape_job(
    responses: DataFrame,
    seeds: DataFrame,
    target: str,
    out: str,
    depth: int = MIN_DEPTH,
    max_pages: int | None = DEFAULT_MAX_PAGES,
    with_seed: bool = True,
    counts: Counts | None = None,
) -> int:
    """Write each value of a target once per seed and give the number of rows."""
    if target not in TARGETS:
        raise ValueError(f"target is one of {sorted(TARGETS)}")
    visits = crawl(responses, seeds, _checked(depth), max_pages, TARGET_FACTS[target], counts)
    return write_ndjson_counted(_rows(scrape(visits, target), with_seed), out)


def summary_job(spark: SparkSession, path: str | list[str], on_bad: str = "fail", counts: Counts | None = None) -> DataFrame:
    """The ten labelled totals of NDJSON files; ``counts`` is ready once they have been read."""
    return summary_report(summarize(read_ndjson(spark, path, on_bad, counts=counts)))


def post_job(responses: DataFrame, out: str) -> None:
    """Write a row per fetched post; without any, nothing."""
    write_posts(post_metadata(responses), out)
