"""Same-host crawl over captured pages, for a table of seeds at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegraph.functions.urls import netloc
from pagegraph.operators.corpus import Corpus, corpus_facts, corpus_of
from pagegraph.operators.counts import Counts
from pagegraph.operators.extract import FACTS, with_split_links
from pagegraph.operators.traverse import (
    MIN_DEPTH,
    child_key,
    clamp_depth,
    first_key,
    key_literal,
    next_frontier,
    seed_frontier,
    union_all,
)
from pagegraph.schemas import VISITS
from pagegraph.session import staged

# Fixed value: pages a crawl visits per seed unless told otherwise.
DEFAULT_MAX_PAGES = 50

VISIT_FACTS = {"title": "string", "links": "array<string>", "emails": "array<string>", "images": "array<string>"}


def _visited_facts(corpus: Corpus, frontier: DataFrame, level: int, fields: Sequence[str], counts: Counts | None) -> DataFrame:
    """Facts of the frontier's pages: the corpus is cut down to them before any page is
    read, and a page is read once however many seeds visit it."""
    # The bound on the key holds for every row; it marks the frontier as the
    # selective side, from which Spark may build a bloom filter over the corpus.
    wanted = frontier.filter(F.col("bfs_key") >= key_literal(first_key(level))).select(F.col("node").alias("requested_url"))
    if corpus.laid_out:
        # The buckets are streamed past the frontier's URLs, neither moved nor sorted.
        wanted = wanted.hint("shuffle_hash")
    met = corpus.pages.join(wanted, "requested_url", "left_semi")
    return met if corpus.read else corpus_facts(met, fields, counts)


def _visit(corpus: Corpus, frontier: DataFrame, level: int, fields: Sequence[str], counts: Counts | None) -> DataFrame:
    """Visit every queued URL; one without response gives status 0 and no content."""
    none = F.array().cast("array<string>")
    same_url = F.col("node") == F.col("requested_url")
    if corpus.read and corpus.laid_out:
        # One pass: the buckets are streamed past the frontier, neither moved nor sorted.
        found = corpus.pages.join(frontier.hint("shuffle_hash"), same_url, "right")
    else:
        found = frontier.join(_visited_facts(corpus, frontier, level, fields, counts), same_url, "left")
    found = found.withColumns({f: F.lit(None).cast(VISIT_FACTS[f]) for f in FACTS if f not in found.columns})
    filled = found.withColumns(
        {
            "url": F.coalesce(F.col("final_url"), F.col("node")),
            "status": F.coalesce(F.col("status"), F.lit(0)),
            "links": F.coalesce(F.col("links"), none),
            "emails": F.coalesce(F.col("emails"), none),
            "images": F.coalesce(F.col("images"), none),
            "level": F.lit(level),
            "seed_netloc": netloc("seed"),
        }
    )
    return with_split_links(filled, "seed_netloc").select(*VISITS.names)


def crawl(
    responses: DataFrame | Corpus,
    seeds: DataFrame,
    depth: int = MIN_DEPTH,
    max_pages: int | None = DEFAULT_MAX_PAGES,
    fields: Sequence[str] = FACTS,
    counts: Counts | None = None,
) -> DataFrame:
    """Pages each seed reaches over links to its own host, breadth first.

    ``responses`` comes from ``read_responses`` or, read already, from ``corpus_facts``;
    ``write_corpus`` and ``write_facts`` lay either out for good. Rows that share a
    ``requested_url`` count as one page, the least by status, final URL and a hash of the
    row; ``dedupe_pages`` chooses by another order. ``depth`` counts levels, the seed's own
    included. ``bfs_key`` of the result is the order of visits of a seed. A page counts
    against ``max_pages`` whatever its status; no page beyond it is read. Facts that are not
    among ``fields`` stay empty, and ``counts`` gets what ``page_facts`` counts.
    """
    spark = seeds.sparkSession
    if max_pages is not None and max_pages < 1:
        return spark.createDataFrame([], VISITS)
    corpus = responses if isinstance(responses, Corpus) else corpus_of(responses)
    depth = clamp_depth(depth)
    frontiers = [seed_frontier(seeds)]
    if depth > 1:
        frontiers = [staged(frontiers[0], "seeds")]
    visits = []
    for level in range(depth):
        last = level == depth - 1
        visited = _visit(corpus, frontiers[-1], level, fields if last else [*fields, "links"], counts)
        if last:
            visits.append(visited)
            break
        # Read by the result and by the next level, so it is kept.
        visits.append(staged(visited, f"visits{level}"))
        links = visits[-1].select("seed", "bfs_key", F.posexplode("internal_links").alias("pos", "node"))
        candidates = links.select("seed", "node", child_key(F.col("bfs_key"), F.col("pos")).alias("bfs_key"))
        frontier = next_frontier(union_all(frontiers), candidates, level + 1, max_pages)
        frontiers.append(staged(frontier, f"frontier{level + 1}"))
        if frontiers[-1].isEmpty():
            break
    return union_all(visits)
