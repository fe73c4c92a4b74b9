"""Pages to crawl over: one a URL and, where many crawls or levels read them, laid out by it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegraph.operators.counts import Counts
from pagegraph.operators.extract import FACTS, page_facts
from pagegraph.operators.keys import one_of_each
from pagegraph.session import bucketed

KEPT = ("requested_url", "status", "final_url")


@dataclass(frozen=True)
class Corpus:
    """Pages, one a URL, with their HTML or, once ``read``, with facts in its place.

    ``laid_out`` pages are bucketed by ``requested_url``: a level of a crawl is joined
    to them where they lie.
    """

    pages: DataFrame
    read: bool
    laid_out: bool = False


def corpus_facts(responses: DataFrame, fields: Sequence[str] = FACTS, counts: Counts | None = None) -> DataFrame:
    """The named facts of every response, for crawls over one corpus that share the reading.

    Worth it when the seeds reach a good part of the corpus; otherwise ``crawl`` reads
    only the pages it visits.
    """
    return page_facts(responses, KEPT, fields=fields, counts=counts)


#: Of pages that share a URL the first by these stays, then by a hash of the row.
ORDER = ("status", "final_url")


def corpus_of(pages: DataFrame) -> Corpus:
    """Responses, or facts of them, as they lie."""
    if "html" not in pages.columns:
        return Corpus(one_of_each(pages, ["requested_url"], ORDER), True)
    hashed = one_of_each(_hashed(pages.select(*KEPT, "html")), ["requested_url"], (*ORDER, "page_hash"))
    return Corpus(hashed.drop("page_hash"), False)


def _hashed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("page_hash", F.xxhash64("html"))


def _laid_out(pages: DataFrame, label: str, buckets: int | None) -> DataFrame:
    """``pages``, with ``html`` or ``page_hash``, bucketed by URL, one a URL.

    Whether a URL is repeated is asked of the table, bucket by bucket and without a shuffle;
    only then is it written anew, and only then are pages with their HTML hashed.
    """
    table = bucketed(pages, label, ["requested_url"], buckets)
    hashed = table if "page_hash" in table.columns else _hashed(table)
    unique = one_of_each(hashed, ["requested_url"], (*ORDER, "page_hash"))
    if unique is not hashed:
        table = bucketed(unique.drop("page_hash"), label, ["requested_url"], buckets)
    return table.drop("page_hash")


def write_corpus(responses: DataFrame, buckets: int | None = None) -> Corpus:
    """Responses written once as a table bucketed by URL, for crawls that visit a part of them."""
    return Corpus(_laid_out(responses.select(*KEPT, "html"), "corpus", buckets), False, True)


def write_facts(
    responses: DataFrame, fields: Sequence[str] = FACTS, buckets: int | None = None, counts: Counts | None = None
) -> Corpus:
    """Facts of every response written once, bucketed by URL, for crawls that visit nearly all; no HTML is moved."""
    facts = page_facts(_hashed(responses.select(*KEPT, "html")), (*KEPT, "page_hash"), fields=fields, counts=counts)
    return Corpus(_laid_out(facts, "facts", buckets), True, True)
