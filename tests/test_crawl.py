"""Traversal and crawl against small graphs and a plain queue."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from pagegraph import session
from pagegraph.operators.corpus import corpus_facts, corpus_of, write_corpus, write_facts
from pagegraph.operators.counts import Counts
from pagegraph.operators.crawl import crawl
from pagegraph.operators.extract import with_split_links
from pagegraph.operators.shape import crawl_rows, dedupe_pages, scrape, scrape_all
from pagegraph.operators.traverse import bfs, clamp_depth
from pagegraph.session import bucketed
from pagegraph.sources.responses import read_responses, read_seeds

HOME = "https://example.com/"


def site(spark, pages):
    """Responses of {path: html or (status, final_url, html)}."""
    rows = []
    for path, page in pages.items():
        status, final_url, html = page if isinstance(page, tuple) else (200, None, page)
        rows.append((HOME + path, status, final_url, html))
    return read_responses(spark.createDataFrame(rows, "url string, status int, final_url string, html string"))


def links(*hrefs):
    return "".join(f'<a href="{h}">x</a>' for h in hrefs)


def seeds_of(spark, *urls):
    return read_seeds(spark.createDataFrame([(u,) for u in urls], "url string"))


def visited(spark, pages, seeds=(HOME,), **limits):
    rows = crawl(site(spark, pages), seeds_of(spark, *seeds), **limits).collect()
    return sorted(rows, key=lambda r: (r.seed, r.bfs_key))


def paths(rows):
    return [r.url.removeprefix(HOME) for r in rows]


GRAPH = {"": links("/a", "/a", "/b"), "a": links("/c", "/", "/b"), "b": links("/c", "/d"), "c": links("/e"), "d": "", "e": ""}


def test_depth_and_first_parent(spark):
    assert paths(visited(spark, GRAPH, depth=1)) == [""]
    assert paths(visited(spark, GRAPH, depth=2)) == ["", "a", "b"]
    rows = visited(spark, GRAPH, depth=3)
    assert paths(rows) == ["", "a", "b", "c", "d"]
    assert [r.level for r in rows] == [0, 1, 1, 2, 2]
    assert paths(visited(spark, GRAPH, depth=99)) == paths(rows)
    assert paths(visited(spark, GRAPH, depth=0)) == [""]
    assert [clamp_depth(d) for d in (-1, 0, 1, 2, 3, 4)] == [1, 1, 1, 2, 3, 3]


def test_page_budget(spark):
    children = {"": links(*[f"/{i}" for i in range(10)])} | {str(i): links(f"/x{i}") for i in range(10)}
    assert paths(visited(spark, children, depth=2, max_pages=3)) == ["", "0", "1"]
    assert visited(spark, children, depth=2, max_pages=0) == []
    assert paths(visited(spark, children, depth=3, max_pages=12)) == ["", *map(str, range(10)), "x0"]
    assert len(visited(spark, children, depth=3, max_pages=None)) == 21


def test_pages_without_body_or_response(spark):
    rows = visited(spark, {"": links("/gone", "/missing"), "gone": (404, None, None)}, depth=2)
    assert [(r.url, r.status, r.title, r.internal_links, r.emails) for r in rows[1:]] == [
        (HOME + "gone", 404, None, [], []),
        (HOME + "missing", 0, None, [], []),
    ]


def test_redirects_keep_their_place_and_may_repeat(spark):
    pages = {
        "": links("/old1", "/old2", "/off"),
        "old1": (200, HOME + "new/", links("x")),
        "old2": (200, HOME + "new/", links("x")),
        "off": (200, "https://other.org/p/q", links("r", HOME + "back")),
        "back": "<title>Back</title>",
    }
    rows = visited(spark, pages, depth=3)
    assert [r.url for r in rows] == [
        HOME, HOME + "new/", HOME + "new/", "https://other.org/p/q", HOME + "new/x", HOME + "back",
    ]
    assert rows[3].internal_links == [HOME + "back"]
    assert rows[3].external_links == ["https://other.org/p/r"]
    assert rows[5].title == "Back" and rows[4].status == 0


def test_many_seeds_crawl_independently(spark):
    pages = GRAPH | {"z/": links("/a")}
    rows = visited(spark, pages, ("HTTPS://Example.com:443", HOME + "b#x", HOME + "b", HOME + "z"), depth=2)
    by_seed = {}
    for row in rows:
        by_seed.setdefault(row.seed, []).append(row.url.removeprefix(HOME))
    assert by_seed == {HOME: ["", "a", "b"], HOME + "b": ["b", "c", "d"], HOME + "z": ["z", "a"]}


def test_crawl_over_facts_equals_crawl_over_pages(spark):
    responses = site(spark, GRAPH)
    seeds = seeds_of(spark, HOME)
    whole = crawl(responses, seeds, depth=3).collect()
    assert sorted(crawl(corpus_facts(responses), seeds, depth=3).collect()) == sorted(whole)


def test_rows_show_five_links(spark):
    pages = {"": "<title>T</title>" + links(*[f"/{i}" for i in range(6)], "https://o.org/1", "https://o.org/2")}
    row = crawl_rows(crawl(site(spark, pages), seeds_of(spark, HOME))).first()
    assert row.links == [HOME + str(i) for i in range(5)]
    assert (row.n_internal_links, row.n_external_links, row.n_emails, row.n_images) == (5, 2, 0, 0)
    assert crawl_rows(crawl(site(spark, pages), seeds_of(spark, HOME))).columns[1:] == [
        "url", "status", "title", "n_internal_links", "links", "level", "external_links",
        "n_external_links", "emails", "n_emails", "images", "n_images",
    ]


def test_scrape_credits_the_first_page(spark):
    pages = {
        "": links("/2", "/1", "mailto:a@x.org", "mailto:b@x.org"),
        "1": links("mailto:c@x.org", "mailto:d@x.org"),
        "2": links("mailto:b@x.org", "mailto:c@x.org", "https://o.org") + "<img src=i.png>",
    }
    visits = crawl(site(spark, pages), seeds_of(spark, HOME), depth=2)
    rows = {(r.kind, r.value): r.source_url for r in scrape(visits, "emails").collect()}
    assert rows == {
        ("email", "a@x.org"): HOME,
        ("email", "b@x.org"): HOME,
        ("email", "c@x.org"): HOME + "2",
        ("email", "d@x.org"): HOME + "1",
    }
    assert [tuple(r) for r in scrape(visits, "offsite").collect()] == [(HOME, "offsite_link", "https://o.org/", HOME + "2")]
    assert [tuple(r) for r in scrape(visits, "images").collect()] == [(HOME, "image", HOME + "i.png", HOME + "2")]
    unknown = scrape(visits, "videos")
    assert unknown.columns == ["seed", "kind", "value", "source_url"] and unknown.count() == 0


def test_urls_without_valid_host_are_kept_but_not_reached(spark):
    rows = [(1, "http://[bad/", "<title>x</title><a href='/a'>"), (2, "http://[worse/", ""), (3, HOME, "")]
    df = read_responses(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert dedupe_pages(df, "requested_url", "page_id").count() == 3
    facts = {r.title: r for r in corpus_facts(df).collect()}
    assert facts["x"].requested_url is None and facts["x"].links == []
    assert [r.url for r in crawl(df, seeds_of(spark, HOME, "http://[bad/")).collect()] == [HOME]


def test_dedupe_keeps_the_smallest_key(spark):
    rows = [(i, "https://e.org/" + "#" * (i % 2) if i % 3 else f"https://e.org/{i}", "h") for i in range(300)]
    df = read_responses(spark.createDataFrame(rows, "page_id long, url string, html string"))
    kept = dedupe_pages(df, "requested_url", "page_id").collect()
    assert len(kept) == 101 and min(r.page_id for r in kept if r.requested_url == "https://e.org/") == 1


def queue_walk(edges, seed, depth, budget):
    """The same search with a queue."""
    children = {}
    for src, pos, dst in sorted(edges):
        children.setdefault(src, []).append(dst)
    queue, seen, out = deque([(seed, 0)]), {seed}, []
    while queue and (budget is None or len(out) < budget):
        node, level = queue.popleft()
        out.append((node, level))
        if level < depth - 1:
            for child in children.get(node, []):
                if child not in seen:
                    seen.add(child)
                    queue.append((child, level + 1))
    return out


@pytest.mark.parametrize("number, depth, budget", [(1, 3, None), (2, 3, 7), (3, 2, 4), (4, 3, 1)])
def test_bfs_is_a_queue(spark, number, depth, budget):
    draw = random.Random(number)
    nodes = [f"n{i}" for i in range(25)]
    # n0 is a hub: a third of all edges leave it.
    edges = [(draw.choice(nodes) if i % 3 else "n0", i, draw.choice(nodes)) for i in range(120)]
    starts = ["n0", "n1", "n2", "lonely"]
    df = spark.createDataFrame(edges, "src string, pos int, dst string")
    seeds = spark.createDataFrame([(s,) for s in starts], "seed string")
    rows = bfs(df, seeds, depth, budget).collect()
    for start in starts:
        mine = sorted((r for r in rows if r.seed == start), key=lambda r: r.bfs_key)
        assert [(r.node, r.level) for r in mine] == queue_walk(edges, start, depth, budget)


def test_bfs_without_budget_for_any_node(spark):
    df = spark.createDataFrame([("a", 0, "b")], "src string, pos int, dst string")
    seeds = df.select(F.col("src").alias("seed"))
    assert bfs(df, seeds, 3, 0).count() == 0


def test_positions_of_any_size(spark):
    """Keys beyond 32 bits sort as they are, up to the largest BIGINT."""
    big = (1 << 63) - 1
    edges = [("s", big, "far"), ("s", (1 << 32) + 1, "b"), ("s", 1 << 32, "a"), ("far", big, "last"), ("a", 0, "first")]
    df = spark.createDataFrame(edges, "src string, pos long, dst string")
    seeds = spark.createDataFrame([("s",)], "seed string")
    rows = sorted(bfs(df, seeds, depth=3).collect(), key=lambda r: r.bfs_key)
    assert [r.node for r in rows] == ["s", "a", "b", "far", "first", "last"]
    assert [r.node for r in sorted(bfs(df, seeds, depth=3, max_nodes=3).collect(), key=lambda r: r.bfs_key)] == ["s", "a", "b"]


def test_negative_positions_are_refused(spark):
    df = spark.createDataFrame([("s", -5, "neg")], "src string, pos long, dst string")
    with pytest.raises(Exception, match="negative link position"):
        bfs(df, spark.createDataFrame([("s",)], "seed string"), depth=2).collect()


def test_repeated_pages_count_once(spark):
    pages = site(spark, {"": links("/a"), "a": "<title>A</title>"})
    twice = pages.unionByName(pages)
    for corpus in (twice, corpus_facts(twice)):
        assert crawl(corpus, seeds_of(spark, HOME), depth=2).count() == 2
        assert crawl(corpus, seeds_of(spark, HOME), depth=2, max_pages=1).count() == 1


def test_which_of_repeated_pages(spark):
    """The least by status, final URL and hash of the row, whatever the order and number of rows."""
    rows = [(HOME, s, None, f"<title>{t}</title>") for s, t in ((503, "c"), (200, "a"), (200, "b"), (200, "a"))]
    rows += [(f"{HOME}{i}", 200, None, "x") for i in range(30)]
    titles = set()
    for order in (rows, rows[::-1]):
        pages = read_responses(spark.createDataFrame(order, "url string, status int, final_url string, html string"))
        corpora = (pages, corpus_facts(corpus_of(pages).pages), write_corpus(pages), write_facts(pages))
        titles |= {crawl(c, seeds_of(spark, HOME)).first().title for c in corpora}
    assert len(titles) == 1 and titles <= {"a", "b"}


def test_repeats_are_sought_without_a_shuffle(spark):
    """Laid out first, then counted bucket by bucket on the URL alone."""
    table = write_corpus(site(spark, GRAPH)).pages
    plan = table.select("requested_url").groupBy("requested_url").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan and "html" not in plan


def test_pages_are_laid_out_unhashed(spark):
    """Bodies are hashed where a URL is repeated only; the table has no hash to write."""
    pages = site(spark, GRAPH)
    for corpus in (write_corpus(pages), write_corpus(pages.unionByName(pages))):
        assert spark.read.parquet(*corpus.pages.inputFiles()).columns == ["requested_url", "status", "final_url", "html"]
        assert corpus.pages.count() == len(GRAPH)


def test_buckets_are_written_without_a_sort(spark):
    """A task of a bucketed write has one bucket, so its rows, bodies included, need no sort."""
    spark.sql("CREATE TABLE unsorted_buckets (url STRING, html STRING) USING parquet CLUSTERED BY (url) INTO 4 BUCKETS")
    write = "EXPLAIN INSERT INTO unsorted_buckets SELECT /*+ REPARTITION(4, url) */ 'u' || id AS url, 'h' AS html FROM range(9)"
    try:
        with session._buckets_unsorted(spark):
            plan = spark.sql(write).first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
        assert "Sort" in spark.sql(write).first()[0]
    finally:
        spark.sql("DROP TABLE unsorted_buckets")
    table = bucketed(spark.range(100), "numbers", ["id"], 4)
    assert sorted(r.id for r in table.collect()) == list(range(100))
    assert spark.conf.get(session.OPEN_WRITERS, "0") == "0"


def test_laid_out_corpora_give_the_same(spark):
    pages = GRAPH | {"z": (200, HOME + "a", links("/c")), "gone": (404, None, None)}
    responses, seeds = site(spark, pages), seeds_of(spark, HOME, HOME + "b", HOME + "z", HOME + "none")
    whole = sorted(crawl(responses, seeds, depth=3, max_pages=4).collect())
    for corpus in (write_corpus(responses), write_facts(responses), write_corpus(responses, buckets=3)):
        assert sorted(crawl(corpus, seeds, depth=3, max_pages=4).collect()) == whole


def test_budget_reads_only_visited_pages(spark):
    """Three seeds of a hundred pages each read as many pages as their budgets allow, and no others."""
    pages = {}
    for s in "abc":
        pages |= {f"{s}": links(*[f"/{s}{i}" for i in range(100)])} | {f"{s}{i}": links(f"/{s}{i + 1}") for i in range(100)}
    responses, seeds = site(spark, pages), seeds_of(spark, *[HOME + s for s in "abc"])
    for corpus in (responses, write_corpus(responses)):
        counts = Counts()
        visits = crawl(corpus, seeds, depth=3, max_pages=5, counts=counts).collect()
        assert len(visits) == 15 and counts.totals()["pages_read"] == 15


def test_levels_leave_the_corpus_in_place(spark):
    """Without broadcasts neither pages nor facts are shuffled or sorted by a level."""
    responses, seeds = site(spark, GRAPH), seeds_of(spark, HOME)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for corpus, body in ((write_corpus(responses), "html"), (write_facts(responses), "links")):
            plan = crawl(corpus, seeds, depth=1)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            assert "Bucketed: true" in plan and "ShuffledHashJoin" in plan
            assert "SortAggregate" not in plan
            scan = max(i for i, line in enumerate(plan.splitlines()) if body in line and "Scan" in line)
            join = max(i for i, line in enumerate(plan.splitlines()) if "ShuffledHashJoin" in line)
            between = plan.splitlines()[join + 1 : scan]
            assert not any("Exchange" in line or "Sort" in line for line in between)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_crawl_reads_wanted_facts_only(spark):
    pages = {"": "<title>T</title>" + links("/a", "mailto:m@x.org"), "a": "<img src=i.png>" + links("https://o.org")}
    responses, seeds = site(spark, pages), seeds_of(spark, HOME)
    for corpus in (responses, write_facts(responses, ("images", "links"))):
        rows = sorted(crawl(corpus, seeds, depth=2, fields=("images",)).collect(), key=lambda r: r.bfs_key)
        assert [r.images for r in rows] == [[], [HOME + "i.png"]]
        assert all(r.title is None and r.emails == [] for r in rows)
    visits = crawl(responses, seeds, depth=2)
    rows = {tuple(r) for t in ("emails", "offsite", "images") for r in scrape(visits, t).collect()}
    assert {tuple(r) for r in scrape_all(visits).collect()} == rows and len(rows) == 3


def test_dedupe_moves_only_possible_copies(spark):
    """Without broadcasts, only pages that hit the filter are shuffled, and results stay exact."""
    rows = [(i, f"http://h/{i // 2 if i < 40 else i}", "x" * 50) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = dedupe_pages(pages, "url", "page_id")
        assert kept.columns == pages.columns
        assert sorted(r.page_id for r in kept.collect()) == [i for i in range(400) if i >= 40 or i % 2 == 0]
        plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        passing = plan[plan.index("Union") : plan.index("SortMergeJoin")]
        assert "hashpartitioning(page_id" not in passing and "LeftAnti" in plan[plan.index("SortMergeJoin") :]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_links_are_split_by_scheme_and_host(spark):
    """The start of a web link tells its host; other schemes are cut."""
    links = ["http://a.b/x", "https://a.b/", "http://a.bc/", "http://a.b:8/", "ftp://a.b/x", "ftp://c.d/x", "tel:1", "https://c.d/"]
    df = spark.createDataFrame([(links, "a.b"), (links, None), (None, "a.b")], "links array<string>, host string")
    got = with_split_links(df, "host").collect()
    assert got[0].internal_links == ["http://a.b/x", "https://a.b/", "ftp://a.b/x"]
    assert got[0].external_links == [u for u in links if u not in got[0].internal_links]
    assert (got[1].internal_links, got[1].external_links) == (["tel:1"], [u for u in links if u != "tel:1"])
    assert got[2].internal_links is None
    plan = with_split_links(df, "host")._jdf.queryExecution().optimizedPlan().toString()
    assert "http, concat(http://, " in plan
