"""Crawl rows, scrape rows and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.operators.keys import split_by
from pagegraph.schemas import SCRAPE_ROWS
from pagegraph.session import staged

# Links a crawl row shows, and the targets of a scrape.
SHOWN_LINKS = 5
TARGETS = {
    "emails": ("email", "emails"),
    "offsite": ("offsite_link", "external_links"),
    "images": ("image", "images"),
}
#: What a crawl has to read of a page for each.
TARGET_FACTS = {"emails": ("emails",), "offsite": ("links",), "images": ("images",)}


def crawl_rows(visits: DataFrame) -> DataFrame:
    """Visits as report rows: the first internal links, whole other lists, counts.
    The count of internal links is that of the links shown."""
    shown = F.slice("internal_links", 1, SHOWN_LINKS)
    return visits.select(
        "seed",
        "url",
        "status",
        "title",
        F.size(shown).alias("n_internal_links"),
        shown.alias("links"),
        "level",
        "external_links",
        F.size("external_links").alias("n_external_links"),
        "emails",
        F.size("emails").alias("n_emails"),
        "images",
        F.size("images").alias("n_images"),
    )


def flatten_values(visits: DataFrame, target: str) -> DataFrame:
    """One row per page and value of a target, with the page's place."""
    kind, column = TARGETS[target]
    return visits.select(
        "seed",
        F.lit(kind).alias("kind"),
        F.explode(column).alias("value"),
        F.col("url").alias("source_url"),
        "bfs_key",
    )


def first_source(rows: DataFrame, keys: list[str], source: str, order: Column) -> DataFrame:
    """Each combination of ``keys`` once, with the source that comes first.

    A value found everywhere is cut to one row per task before the shuffle.
    """
    return rows.groupBy(*keys).agg(F.min_by(source, order).alias(source))


def scrape(visits: DataFrame, target: str) -> DataFrame:
    """Each value once per seed, credited to the first page that has it. An
    unknown target gives no rows."""
    if target not in TARGETS:
        return visits.sparkSession.createDataFrame([], SCRAPE_ROWS)
    return first_source(
        flatten_values(visits, target), ["seed", "kind", "value"], "source_url", F.col("bfs_key")
    )


def scrape_all(visits: DataFrame) -> DataFrame:
    """The rows of every target, in one pass over the visits and one grouping."""
    found = [F.expr(f"transform({column}, v -> named_struct('kind', '{kind}', 'value', v))") for kind, column in TARGETS.values()]
    rows = visits.select("seed", "bfs_key", F.col("url").alias("source_url"), F.inline(F.concat(*found)))
    return first_source(rows, ["seed", "kind", "value"], "source_url", F.col("bfs_key")).select(*SCRAPE_ROWS.names)


def dedupe_pages(pages: DataFrame, url_col: str, order_col: str) -> DataFrame:
    """One page per URL, the one with the smallest ``order_col``, a unique key.

    Keys alone are grouped and joined. A filter sized by the number of surplus keys then lets
    nearly all other pages through as they are; only pages that hit it meet the exact
    list, so hardly any other body is ever shuffled.
    """
    keys = pages.select(url_col, order_col)
    copies = keys.groupBy(url_col).agg(F.min(order_col).alias("kept"), F.count(F.lit(1)).alias("copies"))
    repeated = copies.filter(F.col("copies") > 1).select(url_col, "kept")
    surplus = keys.join(repeated, url_col).filter(F.col(order_col) != F.col("kept")).select(order_col)
    surplus = staged(surplus, "surplus")
    n = surplus.count()
    return split_by(pages, surplus, [order_col], n)[0] if n else pages
