"""Attempt logs to responses."""

import pytest
from pyspark.sql import functions as F

from pagegraph.operators.fetchlog import quarantined_urls, resolve_attempts, usable_body
from pagegraph.sources.responses import read_attempts

SCHEMA = "url string, attempt int, status int, final_url string, content_type string, body string, error string"
HTML = "text/html; charset=utf-8"
T, C = "Timeout", "ConnectionError"


def log(spark, attempts):
    """{url: [status | error | (status, type) | (status, final_url)]} as an attempt log."""
    rows = []
    for url, tries in attempts.items():
        for n, got in enumerate(tries, start=1):
            if isinstance(got, str):
                rows.append((url, n, None, None, None, None, got))
            else:
                status, kind, final_url = got if isinstance(got, tuple) else (got, HTML, url)
                rows.append((url, n, status, final_url, kind, f"body{n}", None))
    return read_attempts(spark.createDataFrame(rows, SCHEMA))


def resolved(spark, attempts, **options):
    rows = resolve_attempts(log(spark, attempts), **options).collect()
    assert len({r.requested_url for r in rows}) == len(rows)
    return {r.requested_url: (r.status, r.final_url, r.html) for r in rows}


def test_one_retry(spark):
    got = resolved(
        spark,
        {
            "ok": [200],
            "json": [(200, "application/json", "json")],
            "retried": [503, 200],
            "refused": [C, 200],
            "down": [503, 503],
            "down-silent": [503, T],
            "silent-down": [T, 503],
            "silent": [T, C],
            "untyped": [(200, None, "untyped")],
            "past": [404, 200],
            "late": [503, 503, 200],
            "once": [503],
        },
    )
    assert got == {
        "ok": (200, "ok", "body1"),
        "json": (200, "json", None),
        "retried": (200, "retried", "body2"),
        "refused": (200, "refused", "body2"),
        "down": (503, "down", None),
        "down-silent": (503, "down-silent", None),
        "silent-down": (503, "silent-down", None),
        "silent": (0, "silent", None),
        "untyped": (200, "untyped", None),
        "past": (404, "past", None),
        "late": (503, "late", None),
        "once": (503, "once", None),
    }


def test_other_retries(spark):
    assert resolved(spark, {"a": [T, T, T]}, retries=2) == {"a": (0, "a", None)}
    assert resolved(spark, {"a": [404], "b": [(302, HTML, "/new")]}, retries=3) == {
        "a": (404, "a", None),
        "b": (302, "/new", None),
    }
    assert resolved(spark, {"a": [T], "b": [500], "c": [200]}, retries=0) == {
        "a": (0, "a", None),
        "b": (500, "b", None),
        "c": (200, "c", "body1"),
    }
    assert resolved(spark, {"a": [200, 200]}, retries=-1) == {"a": (0, "a", None)}


def test_every_kind_of_timeout_and_lost_connection_is_retried(spark):
    attempts = {
        "read": ["ReadTimeout", 200],
        "connect": ["ConnectTimeout"],
        "ssl": ["requests.exceptions.SSLError", 200],
        "proxy": ["ProxyError", "urllib3.ReadTimeout"],
    }
    assert resolved(spark, attempts) == {
        "read": (200, "read", "body2"),
        "connect": (0, "connect", None),
        "ssl": (200, "ssl", "body2"),
        "proxy": (0, "proxy", None),
    }


def test_unhandled_errors(spark):
    loops = "requests.exceptions.TooManyRedirects"
    attempts = {"a": [200, loops], "b": ["InvalidURL", 200], "c": [503, loops, 200], "d": [T, 200]}
    got = resolved(spark, attempts)
    assert got == {"a": (200, "a", "body1"), "d": (200, "d", "body2")}
    refused = {(r.requested_url, r.attempt, r.error) for r in quarantined_urls(log(spark, attempts)).collect()}
    assert refused == {("b", 1, "InvalidURL"), ("c", 2, loops)}
    with pytest.raises(Exception, match="unhandled fetch error: "):
        resolved(spark, attempts, on_error="fail")
    failing = resolve_attempts(log(spark, attempts), on_error="fail")
    for partial in (failing, failing.select("html")):
        with pytest.raises(Exception, match="unhandled fetch error: "):
            partial.count()
    assert resolved(spark, {"a": [200]}, on_error="fail") == {"a": (200, "a", "body1")}
    with pytest.raises(ValueError):
        resolved(spark, attempts, on_error="ignore")


def test_log_schema_and_repeats(spark):
    with pytest.raises(ValueError, match="body"):
        read_attempts(spark.range(1).select(F.col("id").alias("url")))
    twice = log(spark, {"a": [200]})
    assert read_attempts(twice.union(twice), distinct=True).count() == 1


def test_usable_body(spark):
    cases = [(199, HTML, None), (200, HTML, "b"), (299, "application/xhtml+xml", "b"), (300, HTML, None), (200, "x/y", None)]
    df = spark.createDataFrame(cases, "status int, kind string, expected string")
    rows = df.withColumn("got", usable_body(F.col("status"), F.col("kind"), F.lit("b"))).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]
