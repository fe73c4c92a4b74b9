"""Plain pages and references against the tokenizer and the built-ins they stand in for."""

import pytest

from pagegraph.functions.urls import canonical_refs
from pagegraph.operators.elements import PageReader
from pagegraph.operators.extract import mailto_emails, page_facts, page_images, page_links
from pagegraph.operators.plain import FIELDS, read_plain, resolve_plain, split_refs
from pagegraph.sources.responses import read_seeds

ORDER = (
    "<!DOCTYPE html><html><head><title> Order 5 &amp; parts\n</title><script>var a='<a href=\"/no\">';</script></head><body>"
    "<a href=\"/\">home</a><a class=\"x\" href='./6?a=1&amp;b'>next<p>clerk@shop.example</p>a<script>x@y.zz</script>b"
    '<img src="/img/1.png#x"><a href="http://S2.supplier.example:80/p/1/?o=1#top">part<a name="q"><a href="MAILTO: s@x.yz ?b">'
    '<meta name="description" content="d &lt;"></body></html>'
)


@pytest.mark.parametrize(
    "html",
    [
        ORDER,
        "<p>a &lt; b<br>c@d.ef</p>",
        "<title></title><title>later</title>",
        "<title> </title>x",
        '<a href="1" href="2"><img alt="" src="i"><img src="">',
        "<style>p{}</style>a<style>@</style>b",
        "<span>é@ü</span> \n <b> @ </b>",
    ],
)
def test_plain_pages_are_read_as_by_the_tokenizer(html):
    reader = PageReader(FIELDS)
    plain = read_plain(html, reader.want)
    assert plain == {field: reader.read_all(html)[field] for field in FIELDS}


@pytest.mark.parametrize(
    "html",
    ["text", "<p>a<!-- c -->b</p>", "<p>&copy;</p>", "<img src='x'>a</img>b", "<P>a</P>", "<rp>a</rp>", "<a href='a>b'>", "<p>a>b</p>",
     "<title><b>x</b></title>", "<script>x</b></script>", "<script><!--</script>", "<p", "<textarea><p></textarea>", "</title>x"],
)
def test_other_pages_are_left_to_the_tokenizer(html):
    assert read_plain(html, FIELDS) is None
    assert PageReader(("text",)).read(html) == PageReader(("text",)).read_all(html)


def test_first_paragraph_needs_the_tokenizer():
    assert PageReader(("first_p",)).read("<p>a<p>b</p>c</p>d")["first_p"] == "abc"


BASES = ["http://h.ex/", "http://h.ex", "https://a.b/c/d", "http://a/b/", "http://a:80/x", "http://a/x?q", "HTTP://A/", "", "http://a/../b"]
REFS = [
    "/", "/o/1", "./6", "../o/5", "list/3", "/l/3/#here", "http://S5.ex:80/p/7/?o=1#top", "https://Ab.ex", "https://a.b:443", "https://a.b:80/",
    "http://a.b:443/x/", "a/", "../", "..", "../../x", "/a//b", "//h/x", "/a?b", "?b", "#x", "/?x=1", "http:/x", "httpd/x", "/a.b/./c", "/a/..",
    "./a/b.c/?q=2#z", "http://a.b?x=1", "http://a.b#f", "x;p", " /a", "/a\tb", "/é", "ftp://a/b", "tel:1", "http://u@h/x", "HTTP://H/", "", "/a?",
]


def test_plain_references_are_resolved_as_by_the_builtins(spark):
    cases = [(base, ref) for base in BASES for ref in REFS]
    rows = spark.createDataFrame([(i, *case) for i, case in enumerate(cases)], "i int, base string, ref string")
    got = dict(rows.selectExpr("i", "base", "array(ref) AS refs").select("i", canonical_refs("base", "refs")).collect())
    told = {i: resolve_plain(base, [ref]) for i, (base, ref) in enumerate(cases)}
    assert {i: urls for i, urls in told.items() if urls} == {i: got[i] for i, urls in told.items() if urls}
    assert sum(urls is not None for urls in told.values()) > 60
    assert resolve_plain("http://a/", ["/b", "b", "/b/"]) == ["http://a/b"]
    assert resolve_plain("http://a/", ["/b", "ftp://x"]) is None
    assert resolve_plain(None, []) == []


def test_mail_addresses_are_those_of_the_builtins(spark):
    hrefs = ["mailto: a@b ?x", "MAILTO: c\x1c", "mailto:", "mailto: ?", "JAVASCRIPT:x", "", "x", "javascript", "mailto:a?b?c"]
    want = spark.createDataFrame([(hrefs,)], "hrefs array<string>").select(mailto_emails("hrefs")).first()[0]
    assert split_refs(hrefs) == (["x", "javascript"], want)


def test_facts_of_plain_and_other_pages(spark):
    """A page with one odd reference, or one odd tag, gives the same facts as all its parts alone."""
    odd = '<a href="/b"><a href="http://[x/"><a href="/a;p"><img src="/i;p"><img src="/b"><a href="mailto:m@x.yz">'
    pages = [(1, ORDER), (2, odd), (3, "<!-- c -->" + ORDER), (4, None), (5, "")]
    responses = spark.createDataFrame([(i, "http://h.ex/o/5", html) for i, html in pages], "i int, final_url string, html string")
    got = {row.i: row for row in page_facts(responses, ("i",)).collect()}
    assert got[1].links == ["http://h.ex/", "http://h.ex/o/6?a=1&b", "http://s2.supplier.example/p/1?o=1"]
    assert (got[1].title, got[1].emails, got[1].images) == ("Order 5 & parts", ["clerk@shop.example", "s@x.yz"], ["http://h.ex/img/1.png"])
    assert got[3][1:] == got[1][1:]
    assert (got[2].links, got[2].images, got[2].emails) == (["http://h.ex/b", "http://h.ex/a"], ["http://h.ex/b", "http://h.ex/i"], ["m@x.yz"])
    assert all((got[i].title, got[i].links, got[i].emails, got[i].images) == (None, [], [], []) for i in (4, 5))
    hrefs = spark.createDataFrame([(["/b", "/a"], "http://h.ex/")], "refs array<string>, base string")
    assert hrefs.select(page_links("refs", "base")).first()[0] == resolve_plain("http://h.ex/", ["/b", "/a"])
    assert hrefs.select(page_images("refs", "base")).first()[0] == sorted(resolve_plain("http://h.ex/", ["/b", "/a"]))


def test_seeds_are_made_canonical_after_they_are_distinct(spark):
    """The filter of valid seeds stays above a distinct below it."""
    shops = spark.range(1000).selectExpr("id % 3 AS shop").distinct().selectExpr("concat('HTTP://H', shop, '.ex:80') AS url")
    seeds = read_seeds(shops)
    assert sorted(r.seed for r in seeds.collect()) == [f"http://h{i}.ex/" for i in range(3)]
    plan = seeds._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan[plan.rindex("Aggregate [shop") :]


def test_references_are_read_together_but_apart():
    """All of a page are matched at once; one that holds a line break, or is odd, fails them all."""
    assert resolve_plain("http://h.ex/a/b", iter(["httpd/x", "../c/", "HTTPS"])) == ["http://h.ex/a/httpd/x", "http://h.ex/c", "http://h.ex/a/HTTPS"]
    assert resolve_plain("http://h.ex/", ["/a\n/b", "x y"]) is None
    assert resolve_plain("http://h.ex/", ["/a\n/b"]) is None
    assert resolve_plain("http://h.ex/", ["/a", ""]) is None
    assert resolve_plain("http://h.ex/", ["/a", "\r"]) is None


@pytest.mark.parametrize("tag", ["p", "i", "e", "embed", "titles", "tt", "rb", "scripts", "x", "nav", "section"])
def test_tags_with_the_first_letter_of_an_odd_one(tag):
    html = f"<{tag}>a@b.cd<{tag} id='x'></{tag}>e</{tag}>"
    reader = PageReader(FIELDS)
    # A void's end tag is left to the tokenizer.
    plain = read_plain(html, reader.want)
    assert plain is None if tag == "embed" else plain == {field: reader.read_all(html)[field] for field in FIELDS}
