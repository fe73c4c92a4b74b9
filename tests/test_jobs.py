"""The four jobs end to end."""

import json

import pytest

from pagegraph.operators.counts import Counts
from pagegraph.plans.jobs import attempt_responses, crawl_job, post_job, scrape_job, summary_job
from pagegraph.session import staging_dir
from pagegraph.sources.responses import read_responses, read_seeds
from tests.test_summary import written_lines

PAGES = [
    ("http://h/", 200, "<title>Home</title><a href='/b'><a href='/a'><a href='mailto:x@y.org'><img src='i.png'>"),
    ("http://h/a", 200, "<title>A</title><a href='http://o.org/'>"),
    ("http://h/b", 404, None),
]


@pytest.fixture(scope="module")
def responses(spark):
    return read_responses(spark.createDataFrame(PAGES, "url string, status int, html string"))


@pytest.fixture(scope="module")
def seeds(spark):
    return read_seeds(spark.createDataFrame([("HTTP://H:80",)], "url string"))


def test_crawl_scrape_and_summary(spark, tmp_path, responses, seeds):
    crawled, scraped = str(tmp_path / "crawl"), str(tmp_path / "scrape")
    assert crawl_job(responses, seeds, crawled, depth=2, with_seed=False, in_order=True) == 3
    rows = [json.loads(line) for line in written_lines(crawled)]
    assert rows[0] == {
        "url": "http://h/", "status": 200, "title": "Home", "n_internal_links": 2, "links": ["http://h/b", "http://h/a"],
        "level": 0, "external_links": [], "n_external_links": 0, "emails": ["x@y.org"], "n_emails": 1,
        "images": ["http://h/i.png"], "n_images": 1,
    }
    assert [r["url"] for r in rows] == ["http://h/", "http://h/b", "http://h/a"] and rows[1]["title"] is None
    assert scrape_job(responses, seeds, "offsite", scraped, depth=2) == 1
    assert json.loads(written_lines(scraped)[0]) == {
        "seed": "http://h/", "kind": "offsite_link", "value": "http://o.org/", "source_url": "http://h/a",
    }
    report = {r.label: r.value for r in summary_job(spark, [crawled, scraped]).collect()}
    assert report == {
        "Total rows": 4, "Unique URLs": 3, "2xx statuses": 2, "3xx statuses": 0, "4xx statuses": 1, "5xx statuses": 0,
        "Total internal links": 2, "Total external links": 2, "Total emails": 1, "Total images": 1,
    }


def test_crawl_of_an_attempt_log(spark, tmp_path, seeds):
    log = [
        ("HTTP://H:80/", 1, None, None, None, None, "ReadTimeout"),
        ("HTTP://H:80/", 2, 200, "http://h/", "text/html", PAGES[0][2], None),
        ("http://h/a", 1, 503, "http://h/a", None, None, None),
        ("http://h/a", 2, 503, "http://h/a", None, None, None),
        ("http://h/a", 3, 200, "http://h/a", "text/html", PAGES[1][2], None),
        ("http://h/b/", 1, 404, "http://h/b", "text/html", "gone", None),
    ]
    log = spark.createDataFrame(log, "url string, attempt int, status int, final_url string, content_type string, body string, error string")
    statuses = {}
    for retries in (1, 2):
        out = str(tmp_path / f"crawl{retries}")
        assert crawl_job(attempt_responses(log, retries), seeds, out, depth=2, with_seed=False, in_order=True) == 3
        statuses[retries] = [(r["url"], r["status"]) for r in map(json.loads, written_lines(out))]
    assert statuses[1] == [("http://h/", 200), ("http://h/b", 404), ("http://h/a", 503)]
    assert statuses[2][2] == ("http://h/a", 200)


def test_jobs_count_what_they_leave_out(spark, tmp_path, seeds):
    pages = [
        ("http://h/", 200, "<a href='/b'><a href='http://[bad'><a href='http://[worse/'><a href='/a'>"),
        ("http://h/a", 200, "<p>ok</p>"),
        ("http://h/never", 200, "<a href='http://[bad'>"),
    ]
    responses = read_responses(spark.createDataFrame(pages, "url string, status int, html string"))
    counts = Counts()
    assert crawl_job(responses, seeds, str(tmp_path / "c"), depth=2, counts=counts) == 3
    assert counts.totals() == {"pages_read": 2, "pages_refused": 0, "refs_left_out": 2}
    counts = Counts()
    assert scrape_job(responses, seeds, "emails", str(tmp_path / "s"), depth=2, counts=counts) == 0
    assert counts.totals()["pages_read"] == 2
    (tmp_path / "x.ndjson").write_text('{"url": "u"}\noops\n')
    counts = Counts()
    assert summary_job(spark, str(tmp_path / "x.ndjson"), "quarantine", counts).first().value == 1
    assert counts.totals() == {"lines_rejected": 1}


def test_limits_are_checked(tmp_path, responses, seeds):
    with pytest.raises(ValueError, match="depth"):
        crawl_job(responses, seeds, str(tmp_path / "x"), depth=4)
    with pytest.raises(ValueError, match="target"):
        scrape_job(responses, seeds, "videos", str(tmp_path / "x"))
    assert crawl_job(responses, seeds, str(tmp_path / "none"), max_pages=0) == 0
    assert (tmp_path / "none").exists()


def test_posts(spark, tmp_path, responses):
    post_job(responses, str(tmp_path / "posts"))
    assert len(written_lines(str(tmp_path / "posts"))) == 2
    post_job(responses.filter("html IS NULL"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_staging_follows_the_session(spark):
    assert staging_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
