"""URL columns against fixed cases and against the stdlib's own URL rules."""

import unicodedata
from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagegraph.functions import urls

PAGES = "/root/testdata/sf0.01/pages.parquet"


def expected_canonical(url):
    """The same form by way of the stdlib, or None where it refuses the URL."""
    try:
        p = urlparse(url)
    except ValueError:
        return None
    scheme, host = p.scheme.lower(), p.netloc.lower()
    for known, port in urls.DEFAULT_PORTS.items():
        if scheme == known:
            host = host.removesuffix(port)
    path = p.path if p.path == "/" else p.path.removesuffix("/") if p.path else "/"
    return urlunparse((scheme, host, path, "", p.query, ""))


def expected_joined(base, ref):
    try:
        return urljoin(base, ref)
    except ValueError:
        return None


NORMAL_FORMS = [
    ("HTTP://Example.COM:80/SomePath/", "http://example.com/SomePath"),
    ("https://Example.COM:443/foo/", "https://example.com/foo"),
    ("https://Example.COM:8443/foo/", "https://example.com:8443/foo"),
    ("https://Example.com/path/page#section", "https://example.com/path/page"),
    ("https://Example.com/path/?a=1&b=2#frag", "https://example.com/path?a=1&b=2"),
    ("https://Example.com", "https://example.com/"),
    ("http://h/a;jsessionid=1", "http://h/a"),
    ("http://h/a//", "http://h/a/"),
    ("http://h/a?", "http://h/a"),
    ("tel:12;x", "tel:12"),
    ("data:image/png;base64,AA/", "data:image/png;base64,AA"),
]


def test_normal_forms(spark):
    df = spark.createDataFrame(NORMAL_FORMS, "url string, expected string")
    rows = df.withColumn("got", urls.normalize_url("url")).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


def test_same_host(spark):
    cases = [
        ("https://Example.com/path", True),
        ("https://sub.example.com/path", False),
        ("https://other.com/", False),
    ]
    df = spark.createDataFrame(cases, "url string, expected boolean")
    rows = df.withColumn("got", urls.same_host("url", "'example.com'")).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


BASES = [
    "http://h.org/a/b/c?q=1#f",
    "http://h.org",
    "http://h.org/",
    "https://u:p@H.org:443/x/y;p=1/z;q",
    "http://h.org/a//b/",
    "http://h.org/a/b;k",
    "http:x/y",
    "ftp://f.org/d/e",
]
REFS = [
    "", " ", "x", "./x", "../x", "../../../x", "/x", "//other.org/p", "//other.org", "?z=2", "#t", "x#t", ";v",
    ";", "x;", "x;y;", "x/;y", "a//b", "//", "///x", "/a//b", "/..", "/.", "..", ".", "a/../b/./c/..", "/a/b/../..",
    "http:foo", "http:/foo", "http:", "https://S.org:443", "HTTP://X.org:80/a/", "mailto:a@b.c", " javascript:x",
    "tel:1;2", "data:image/png;base64,A/#x", "ftp://z/a", "x y", "x\ty\n", "\x01/x", "1a:b", "a+b:c", "a_b:c", ":x",
    "http://[::1]/x", "http://[::1", "http://]x/", "http://[zz]/", "http://[v1.a]/", "http://[1:2:3:4:5:6:7:8]:80/",
    "http://[1.2.3.4]/", "http://a／b/", "//℀/", "http://h.org:80", "?", "/x?#", "x?a;b", "für", "/the,", "/x/.;p",
    "..;p", "/a/..;p", "x/..", "x/.", "http://h.org/a/../b", "file:///etc", "file:x", "/x//", "http://[1::2::3]/",
]


def test_resolution_and_canonical_refs_follow_the_stdlib(spark):
    pairs = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(pairs, "base string, ref string")
    got = df.select(
        "base",
        "ref",
        urls.resolve_url("base", "ref").alias("joined"),
        urls.canonical_refs("base", "array(ref)")[0].alias("canonical"),
    ).collect()
    wrong = []
    for row in got:
        joined = expected_joined(row.base, row.ref)
        canonical = None if joined is None else expected_canonical(joined)
        if row.joined != joined or (row.ref and row.canonical != canonical):
            wrong.append((row.base, row.ref, row.joined, joined, row.canonical, canonical))
    assert wrong == []


PIECES = st.sampled_from(
    ["a", "B", "/", "//", "..", ".", ";", "?", "#", ":", "http:", "https://", "h.org", ":80", ":443", "@", " ", "%20", "é"]
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=7).map("".join), min_size=200, max_size=200))
def test_random_references_follow_the_stdlib(spark, refs):
    base = "https://h.org/d/e?f"
    df = spark.createDataFrame([(r,) for r in refs], "ref string")
    got = df.select(
        "ref",
        urls.normalize_url("ref").alias("normal"),
        urls.canonical_refs(f"'{base}'", "array(ref)")[0].alias("canonical"),
    ).collect()
    for row in got:
        assert row.normal == expected_canonical(row.ref), row.ref
        if row.ref:
            assert row.canonical == expected_canonical(urljoin(base, row.ref)), row.ref


def test_every_page_url(spark):
    df = spark.read.parquet(PAGES).select("url")
    rows = urls.canonicalize_urls(df, "url").collect()
    assert len(rows) == 250
    for row in rows:
        assert row.canonical_url == expected_canonical(row.url)
        assert row.netloc == urlparse(row.canonical_url).netloc
    again = spark.createDataFrame([(r.canonical_url,) for r in rows], "url string")
    assert again.filter(urls.normalize_url("url") != F.col("url")).count() == 0


def test_canonicalize_against_a_base(spark):
    df = spark.createDataFrame([("../x/", "http://H.org/a/b")], "ref string, base string")
    row = urls.canonicalize_urls(df, "ref", "base").first()
    assert (row.canonical_url, row.netloc) == ("http://h.org/x", "h.org")


@pytest.mark.parametrize("base, ref", [("g", "b"), ("b", "g"), ("r", "w"), ("c", "p"), ("s", "f")])
def test_any_column_names(spark, base, ref):
    df = spark.createDataFrame([("http://h.org/a/b?q", "../x;y#z")], f"{base} string, {ref} string")
    row = df.select(urls.resolve_url(base, ref), urls.canonical_refs(base, f"array({ref})")).first()
    assert tuple(row) == ("http://h.org/x;y#z", ["http://h.org/x"])
    again = urls.canonicalize_urls(df, ref, base).first()
    assert (again.canonical_url, again.netloc) == ("http://h.org/x", "h.org")


def test_hidden_delimiters_are_complete():
    hidden = [
        c
        for c in map(chr, range(0x80, 0x110000))
        if any(d in unicodedata.normalize("NFKC", c) for d in "/?#@:")
    ]
    assert "".join(hidden) == urls.HIDDEN_DELIMITERS


@pytest.mark.parametrize("url", [None])
def test_null_url(spark, url):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(urls.normalize_url("url").alias("u")).first().u is None


NEAR_CANONICAL = [
    "http://h1.ex/", "https://h.ex/o/12", "http://h.ex/a.b/../c", "http://h.ex//a", "http://./-", "http://h.ex/a/", "http://h.ex//", "http://h.ex",
    "http://H.ex/a", "HTTP://h.ex/a", "http://h.ex:80/a", "http://h.ex/a?b", "http://h.ex/a#b", "http://h.ex/a;p", "http://h.ex/a\n",
    "http://h.ex/\ta", "http:///a", "http://[x/a", "ftp://h.ex/a/", "http://é.ex/a", "http://h.ex/é/", "http://u@h.ex/a",
]


def test_canonical_urls_pass_as_they_are(spark):
    """The short way gives what the long one does, which a blank in front forces."""
    df = spark.createDataFrame([(u, f" {u}") for u in NEAR_CANONICAL], "url string, blank string")
    got = df.select("url", urls.normalize_url("url").alias("got"), urls.normalize_url("blank").alias("whole"))
    assert all(row.got == row.whole for row in got.collect())
    assert df.filter(f"url rlike r'{urls._CANONICAL}'").count() == 5
    assert df.filter(f"url rlike r'{urls._CANONICAL}'").filter(urls.normalize_url("url") != F.col("url")).count() == 0
    assert "RLIKE" in got._jdf.queryExecution().optimizedPlan().toString()
