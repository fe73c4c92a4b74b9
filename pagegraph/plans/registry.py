"""The queries this engine registers, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegraph.functions.text import emails_in, post_username
from pagegraph.functions.urls import canonicalize_urls, netloc
from pagegraph.operators.corpus import write_corpus, write_facts
from pagegraph.operators.counts import Counts
from pagegraph.operators.crawl import crawl
from pagegraph.operators.elements import extract_elements
from pagegraph.operators.extract import (
    FACTS,
    page_descriptions,
    page_emails,
    page_title,
    post_metadata,
    profile_pages,
)
from pagegraph.operators.fetchlog import DEFAULT_RETRIES, quarantined_urls, resolve_attempts
from pagegraph.operators.shape import TARGET_FACTS, crawl_rows, dedupe_pages, first_source, scrape, scrape_all
from pagegraph.operators.summary import summarize, summary_report
from pagegraph.operators.traverse import MAX_DEPTH, bfs
from pagegraph.plans import derived
from pagegraph.plans.derived import table
from pagegraph.plans.jobs import attempt_responses
from pagegraph.session import passing, staged, staging_path
from pagegraph.sources.ndjson import parse_lines, read_ndjson, write_ndjson, write_ndjson_counted, write_posts
from pagegraph.sources.responses import read_attempts, read_responses, read_seeds
from pagegraph.streaming import streams


def _long(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def _count(name: str, alias: str) -> Column:
    return F.size(name).cast("bigint").alias(alias)


def page_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given pages as responses, with the host of each."""
    responses = read_responses(table(spark, sf_dir, "pages"))
    return responses.withColumn("host", netloc("requested_url"))


def page_titles(spark, sf_dir):
    elements = extract_elements(page_responses(spark, sf_dir), ("title_raw",), ("page_id",))
    return elements.select("page_id", page_title(F.col("title_raw")).alias("title"))


def page_links(spark, sf_dir):
    profile = profile_pages(page_responses(spark, sf_dir), "host", ("page_id",))
    links = profile.select("page_id", F.posexplode("internal_links").alias("pos", "link"))
    return links.select("page_id", _long("pos"), "link")


def page_profile_counts(spark, sf_dir):
    profile = profile_pages(page_responses(spark, sf_dir), "host", ("page_id",))
    return profile.select(
        "page_id",
        "url",
        _count("internal_links", "n_internal_links"),
        _count("external_links", "n_external_links"),
        _count("emails", "n_emails"),
        _count("images", "n_images"),
    )


def url_normalize(spark, sf_dir):
    return canonicalize_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url")


def url_dedupe(spark, sf_dir):
    pages = read_responses(table(spark, sf_dir, "pages"))
    sized = pages.select("page_id", "requested_url", F.length("html").cast("bigint").alias("n_chars"))
    return dedupe_pages(sized, "requested_url", "page_id")


def host_page_counts(spark, sf_dir):
    pages = canonicalize_urls(table(spark, sf_dir, "pages").select("url"), "url")
    return pages.groupBy("netloc").agg(F.count(F.lit(1)).alias("n_pages"))


def text_emails(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").filter(F.contains("text", F.lit("@")))
    found = documents.select("doc_id", F.explode(F.array_distinct(emails_in(F.col("text")))).alias("email"))
    return found


def emails_first_seen(spark, sf_dir):
    found = text_emails(spark, sf_dir)
    return first_source(found, ["email"], "doc_id", F.col("doc_id"))


def page_email_list(spark, sf_dir):
    elements = extract_elements(page_responses(spark, sf_dir), ("hrefs", "at_text"), ("page_id",))
    return elements.select("page_id", F.explode(page_emails("hrefs", "at_text")).alias("email"))


def page_description_list(spark, sf_dir):
    return page_descriptions(page_responses(spark, sf_dir), ("page_id",))


def bfs_levels(spark, sf_dir):
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("seed"))
    reached = bfs(derived.geo_edges(spark, sf_dir), regions, depth=3)
    return reached.select("seed", "node", _long("level"))


def bfs_budget(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("seed"))
    reached = bfs(derived.order_edges(spark, sf_dir), customers, depth=3, max_nodes=20)
    return reached.select("seed", "node", _long("level"))


def host_crawl(spark, sf_dir, depth: int = MAX_DEPTH) -> DataFrame:
    """Crawl of the given pages, one seed per host."""
    responses = page_responses(spark, sf_dir)
    keys = canonicalize_urls(table(spark, sf_dir, "pages").select("url"), "url")
    seeds = keys.groupBy("netloc").agg(F.min("canonical_url").alias("url"))
    corpus = write_facts(dedupe_pages(responses, "requested_url", "page_id"))
    return crawl(corpus, read_seeds(seeds), depth=depth)


def _visit_columns(visits: DataFrame) -> DataFrame:
    return visits.select(
        "seed",
        "url",
        _long("status"),
        "title",
        _long("level"),
        _count("internal_links", "n_internal"),
        _count("external_links", "n_external"),
        _count("emails", "n_emails"),
        _count("images", "n_images"),
    )


def crawl_visits(spark, sf_dir):
    return _visit_columns(host_crawl(spark, sf_dir))


def crawl_clamped(spark, sf_dir):
    """The same from a depth far beyond the greatest."""
    return _visit_columns(host_crawl(spark, sf_dir, depth=99))


def crawl_row_links(spark, sf_dir):
    rows = crawl_rows(host_crawl(spark, sf_dir))
    return rows.select(
        "seed", "url", _long("status"), _long("level"), _long("n_internal_links"), F.posexplode_outer("links").alias("pos", "link")
    ).select("seed", "url", "status", "level", "n_internal_links", _long("pos"), "link")


def shop_crawl(
    spark, sf_dir, max_pages: int | None = None, fields: Sequence[str] = FACTS, counts: Counts | None = None
) -> DataFrame:
    """Crawl of the derived shops, three levels deep.

    Without a budget nearly every page is visited: each is read once, and its facts are
    laid out by URL. With one, the pages are, and only those visited are read.
    """
    responses = read_responses(derived.shop_pages(spark, sf_dir))
    return _crawl_of(responses, spark, sf_dir, max_pages, fields, counts)


def _crawl_of(
    responses: DataFrame, spark, sf_dir, max_pages: int | None, fields: Sequence[str] = FACTS, counts: Counts | None = None
) -> DataFrame:
    seeds = read_seeds(derived.shop_seeds(spark, sf_dir))
    corpus = write_facts(responses, [*fields, "links"], counts=counts) if max_pages is None else write_corpus(responses)
    return crawl(corpus, seeds, depth=3, max_pages=max_pages, fields=fields, counts=counts)


def crawl_shop_attempts(spark, sf_dir):
    """The same crawl from a log of fetch attempts."""
    log = staged(derived.shop_attempts(spark, sf_dir), "shop-attempts")
    return _visit_columns(_crawl_of(attempt_responses(log), spark, sf_dir, None))


def crawl_shops(spark, sf_dir):
    return _visit_columns(shop_crawl(spark, sf_dir))


def crawl_shops_budget(spark, sf_dir):
    return _visit_columns(shop_crawl(spark, sf_dir, 100))


def crawl_shops_read(spark, sf_dir):
    """What the crawl with a budget has read and left out, counted in passing."""
    counts = Counts()
    shop_crawl(spark, sf_dir, 100, counts=counts).write.format("noop").mode("overwrite").save()
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.totals().items()])


def crawl_shop_rows(spark, sf_dir):
    rows = crawl_rows(shop_crawl(spark, sf_dir))
    return rows.groupBy("seed", "level", "status").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("n_internal_links").alias("n_internal_links"),
        F.sum("n_external_links").alias("n_external_links"),
        F.sum("n_emails").alias("n_emails"),
        F.sum("n_images").alias("n_images"),
    ).withColumns({"level": F.col("level").cast("bigint"), "status": F.col("status").cast("bigint")})


def page_visits(spark, sf_dir) -> DataFrame:
    """Given pages as visits in page order, all seen from the first host."""
    responses = page_responses(spark, sf_dir)
    hosts = canonicalize_urls(table(spark, sf_dir, "pages").select("url"), "url")
    first_host = hosts.agg(F.min("netloc")).scalar()
    profile = profile_pages(responses.withColumn("seed_netloc", first_host), "seed_netloc", ("page_id", "seed_netloc"))
    return profile.withColumns(
        {
            "seed": F.col("seed_netloc"),
            "status": F.lit(200),
            "level": F.lit(0),
            "bfs_key": F.col("page_id"),
        }
    )


def _scrape(target: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: scrape(page_visits(spark, sf_dir), target)


def _scrape_shops(target: str) -> Callable[[SparkSession, str], DataFrame]:
    """Scrapes of the shops' crawl, which reads what the target needs."""
    return lambda spark, sf_dir: scrape(shop_crawl(spark, sf_dir, fields=TARGET_FACTS[target]), target)


def _written(frame: DataFrame, label: str, compressed: bool = False) -> str:
    path = staging_path(frame.sparkSession, label)
    write_ndjson(frame, path, compressed)
    return path


def summary_crawl(spark, sf_dir):
    rows = crawl_rows(page_visits(spark, sf_dir)).drop("seed")
    return summarize(read_ndjson(spark, _written(rows, "crawl")))


def summary_scrape(spark, sf_dir):
    return summarize(read_ndjson(spark, _written(scrape_all(page_visits(spark, sf_dir)).drop("seed"), "scrapes")))


def summary_by_file(spark, sf_dir):
    """Totals of each of several files: crawl rows and scrape rows of the given pages."""
    visits = staged(page_visits(spark, sf_dir), "visits")
    frames = {"crawl": crawl_rows(visits)} | {t: scrape(visits, t) for t in ("offsite", "emails")}
    rows = read_ndjson(spark, [_written(frame.drop("seed"), label) for label, frame in frames.items()], with_file=True)
    label = F.regexp_extract("file", r"/([a-z]+)-[0-9a-f]{32}/", 1)
    return summarize(rows.withColumn("run", label).drop("file"), ["run"])


#: Values of scrapes are grouped for one such part of the seeds after the other: a shuffle holds only that.
SEED_PARTS = 2


def mixed_rows(spark, sf_dir) -> DataFrame:
    """Crawl rows, scrape rows of every target and post rows of derived pages.

    Tables go as soon as nothing reads them: those of the crawl once its visits are written,
    the visits once their rows are. Scrapes come first, as their grouping takes most room.
    """
    posts = post_metadata(read_responses(derived.post_pages(spark, sf_dir), final_as_given=True))
    with passing(spark) as block:
        with passing(spark):
            visits = block.keep(shop_crawl(spark, sf_dir), "visits")
        part = F.pmod(F.xxhash64("seed"), F.lit(SEED_PARTS))
        frames = [("scrapes", scrape_all(visits.filter(part == i))) for i in range(SEED_PARTS)]
        frames += [("crawl", crawl_rows(visits)), ("posts", posts)]
        paths = [_written(frame.drop("seed"), label, compressed=True) for label, frame in frames]
    return read_ndjson(spark, paths)


def summary_mixed(spark, sf_dir):
    return summarize(mixed_rows(spark, sf_dir))


def summary_lines(spark, sf_dir):
    report = summary_report(summary_crawl(spark, sf_dir))
    return report.withColumn("ordinal", F.col("ordinal").cast("bigint"))


def _event_log(spark, sf_dir) -> DataFrame:
    log = read_attempts(derived.event_attempts(spark, sf_dir))
    # Later attempts never count; said here, it bounds the ranking of a busy user.
    return staged(log.filter(F.col("attempt") <= DEFAULT_RETRIES + 1), "attempts")


def quarantined(spark, sf_dir):
    return quarantined_urls(_event_log(spark, sf_dir)).select("requested_url", _long("attempt"), "error")


def resolved_responses(spark, sf_dir):
    resolved = resolve_attempts(_event_log(spark, sf_dir), DEFAULT_RETRIES)
    return resolved.withColumn("status", F.col("status").cast("bigint"))


def post_usernames(spark, sf_dir):
    texts = derived.post_texts(spark, sf_dir)
    return texts.select("c_custkey", post_username(F.col("description"), F.col("og_title")).alias("username"))


def post_rows(spark, sf_dir):
    posts = post_metadata(read_responses(derived.post_pages(spark, sf_dir), final_as_given=True))
    return posts.withColumn("status", F.col("status").cast("bigint"))


def posts_written(spark, sf_dir):
    """Post rows as the sink has written them."""
    rows = post_rows(spark, sf_dir)
    out = staging_path(spark, "posts")
    write_posts(rows, out)
    return spark.read.schema(rows.schema).json(out)


def rows_written(spark, sf_dir):
    """The number of crawl rows of the given pages, counted as they are written."""
    rows = crawl_rows(page_visits(spark, sf_dir)).drop("seed")
    n = write_ndjson_counted(rows, staging_path(spark, "counted"))
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n_rows"))


def _streamed_responses(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "pages").schema
    pages = spark.readStream.schema(schema).parquet(f"{sf_dir}/pages*.parquet")
    return read_responses(pages).withColumn("host", netloc("requested_url"))


def _run(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over what has arrived and give its result as a table."""
    spark, out = stream.sparkSession, staging_path(stream.sparkSession, label)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{out}-progress")
    if mode == "append":
        writer = writer.format("parquet").option("path", out)
    else:
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def stream_page_links(spark, sf_dir):
    profiles = streams.stream_profiles(_streamed_responses(spark, sf_dir), "host", ("page_id",))
    arrived = _run(profiles, "stream-profiles")
    return arrived.select("page_id", F.posexplode("internal_links").alias("pos", "link")).select(
        "page_id", _long("pos"), "link"
    )


def stream_scrape_emails(spark, sf_dir):
    """Each address of the arriving pages with the page that first had it."""
    profiles = streams.stream_profiles(_streamed_responses(spark, sf_dir), "host", ("page_id",))
    out = staging_path(spark, "stream-scrape")
    first = streams.stream_first_sources(streams.stream_values(profiles, "emails", "page_id"), "page_id")
    writer = first.writeStream.outputMode("update").option("checkpointLocation", f"{out}-progress")
    writer.foreachBatch(streams.write_batches(out)).trigger(availableNow=True).start().awaitTermination()
    return streams.read_batches(spark, out)


def _streamed_crawl_rows(spark, sf_dir) -> DataFrame:
    path = _written(crawl_rows(page_visits(spark, sf_dir)).drop("seed"), "crawl")
    lines = spark.readStream.schema("value string").text(path)
    return parse_lines(lines).select("v")


def stream_summary_totals(spark, sf_dir):
    return _run(streams.stream_summary(_streamed_crawl_rows(spark, sf_dir)), "stream-summary", "complete")


def stream_unique_urls(spark, sf_dir):
    unique = streams.stream_unique_urls(_streamed_crawl_rows(spark, sf_dir))
    return _run(unique, "stream-unique", "complete")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "page_title": page_titles,
    "page_links": page_links,
    "page_profile_counts": page_profile_counts,
    "url_normalize": url_normalize,
    "url_dedupe": url_dedupe,
    "host_page_counts": host_page_counts,
    "text_emails": text_emails,
    "emails_first_seen": emails_first_seen,
    "page_emails": page_email_list,
    "page_description": page_description_list,
    "bfs_levels": bfs_levels,
    "bfs_budget": bfs_budget,
    "crawl_visits": crawl_visits,
    "crawl_rows": crawl_row_links,
    "crawl_shops": crawl_shops,
    "crawl_shops_budget": crawl_shops_budget,
    "crawl_shop_rows": crawl_shop_rows,
    "crawl_shop_attempts": crawl_shop_attempts,
    "scrape_offsite": _scrape("offsite"),
    "scrape_emails": _scrape("emails"),
    "scrape_shop_emails": _scrape_shops("emails"),
    "scrape_shop_offsite": _scrape_shops("offsite"),
    "scrape_shop_images": _scrape_shops("images"),
    "summary_crawl": summary_crawl,
    "summary_scrape": summary_scrape,
    "summary_by_file": summary_by_file,
    "summary_mixed": summary_mixed,
    "summary_report": summary_lines,
    "resolve_attempts": resolved_responses,
    "quarantined_urls": quarantined,
    "post_username": post_usernames,
    "post_metadata": post_rows,
    "stream_page_links": stream_page_links,
    "stream_scrape_emails": stream_scrape_emails,
    "stream_summary": stream_summary_totals,
    "stream_unique_urls": stream_unique_urls,
    "crawl_clamped": crawl_clamped,
    "crawl_shops_read": crawl_shops_read,
    "posts_written": posts_written,
    "rows_written": rows_written,
}
