"""Page elements and page facts on small pages."""

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagegraph.operators import extract
from pagegraph.operators.elements import PageReader, extract_elements
from pagegraph.schemas import ELEMENTS
from pagegraph.sources.responses import read_responses


def read(html):
    return PageReader(ELEMENTS).read(html)


def profiles(spark, pages, host="example.com", base="https://example.com/"):
    rows = [(i, f"{base}?{i}", base, html) for i, html in enumerate(pages)]
    df = spark.createDataFrame(rows, "i int, url string, final_url string, html string")
    responses = read_responses(df).withColumn("host", F.lit(host))
    return sorted(extract.profile_pages(responses, "host", ["i"]).collect(), key=lambda r: r.i)


@pytest.mark.parametrize(
    "html, title",
    [
        ("<title>a</title>", "a"),
        ("<title>a &amp; b&#64;c &unknown; &copy</title>", "a & b@c &unknown ©"),
        ("<title>a<!-- b -->c</title>", None),
        ("<title><b>deep</b></title>", "deep"),
        ("<title><b>x</b>y</title>", None),
        ("<title><br></title>", None),
        ("<title></title><title>later</title>", None),
        ("<title>open", "open"),
        ("<p>no title</p>", None),
        ("<TITLE>Upper</TITLE>", "Upper"),
    ],
)
def test_sole_string_of_first_title(html, title):
    assert read(html)["title_raw"] == title


@pytest.mark.parametrize(
    "html, shown",
    [
        ("<p> a <b>b</b> c</p>", "a b c"),
        ("a<script>x@y.com</script><style>s</style><template><p>t</p></template>b", "a b"),
        ("<ruby>k<rt>r</rt><rp>(</rp></ruby>", "k"),
        ("a<!-- c -->b<!DOCTYPE x><?pi?>", "a b"),
        ("a<![CDATA[ cd ]]>b", "a cd b"),
        ("one<br>two</br>three", "one twothree"),
        ("one</br>two", "one two"),
        ("x &lt;b&gt; &#x41;&#150;&#0;", "x <b> A–�"),
        ("unclosed <div>text", "unclosed text"),
        ("a < b", "a < b"),
        ("", ""),
    ],
)
def test_visible_text(html, shown):
    assert read(html)["text"] == shown


@pytest.mark.parametrize(
    "html, first",
    [
        ("<p>a<p>b</p>c</p>d", "abc"),
        ("<p> a <b> b </b></p><p>c</p>", "ab"),
        ("<p><b>a<br><p>b</p></article>", "ab"),
        ("<p></p><p>x</p>", ""),
        ("</p><div>x</div>", ""),
        ("<article><p>a<p>b</article>c", "ab"),
    ],
)
def test_first_paragraph_without_implied_ends(html, first):
    assert read(html)["first_p"] == first


def test_attributes():
    page = read('<a href=x HREF="y&amp;z"><a href><a name=q><img src=i><img><meta name=n content><meta property=p>')
    assert page["hrefs"] == ["y&z", ""]
    assert page["srcs"] == ["i"]
    assert page["metas"] == [
        {"name": "n", "property": None, "content": ""},
        {"name": None, "property": "p", "content": None},
    ]


def test_text_with_addresses_only():
    assert read("<p>a@b.org</p><p>none</p><p>c@<b>d.org</b></p>")["at_text"] == "a@b.org c@"


class Tokenizer(PageReader):
    """The reader with every tag left to the tokenizer."""

    parse_starttag = HTMLParser.parse_starttag
    parse_endtag = HTMLParser.parse_endtag


MARKUP = st.sampled_from(
    ["<a", "<p", "<img", "<meta", "<b>", "<br>", "<br/>", "<title>", "</title>", "<script>", "</script>", "</a>", "</p>", "</b >", "<P>",
     ' href="x"', " href='y&amp;'", " src=z", ' name="d" content="a>b"', ' property="p"', " ", ">", "/>", "<", "&amp;", "&#65;", "&x",
     "text", "a@b.co", "<!-- c -->", "<!--", "<![CDATA[q]]>", "</", "\n", "<style>", "</style>", "<textarea>", "</textarea>", '"', "'"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(MARKUP, max_size=14).map("".join))
def test_plain_tags_read_as_the_tokenizer_reads_them(html):
    assert PageReader(ELEMENTS).read(html) == Tokenizer(ELEMENTS).read(html)


def test_elements_keep_rows_and_mark_refused_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<title>t</title>"), (4, "<![bogus[x]]>")], "k int, html string")
    rows = {r.k: r for r in extract_elements(df, ("title_raw", "hrefs")).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1].hrefs is None and rows[2].title_raw is None and rows[3].title_raw == "t"
    assert rows[3].parse_error is None and rows[4].parse_error is not None and rows[4].hrefs is None
    with pytest.raises(ValueError):
        extract_elements(df, ("no_such",))


def test_profiles(spark):
    pages = [
        "<title>  Example Page  </title>",
        "<title>   </title>",
        "<a href='mailto:a@x.org'>m</a><a href='MAILTO: b@x.org ?subject=s'>m</a><p>a@x.org</p>"
        "<a href='mailto:'></a><a href='mailto:   '></a>",
        "<img src='/img/a.png'><img src='https://example.com/img/a.png#foo'><img src=''><img>",
        "<a href='/about/'>1</a><a href='/about'>2</a><a href='https://Example.com:443/b#x'>3</a>"
        "<a href='https://other.com/p/'>4</a><a href='javascript:void(0)'>5</a><a href='Mailto:x@y.zz'>6</a>"
        "<a href='tel:123'>7</a><a href=''>8</a><a href=' javascript:x'>9</a><a href='http://[bad/'>10</a>"
        "<a href='https://sub.example.com/'>11</a>",
        None,
        "",
    ]
    rows = profiles(spark, pages)
    assert [r.title for r in rows[:2]] == ["Example Page", None]
    assert rows[2].emails == ["a@x.org", "b@x.org"]
    assert rows[3].images == ["https://example.com/img/a.png"]
    assert rows[4].internal_links == ["https://example.com/about", "https://example.com/b"]
    assert rows[4].external_links == ["https://other.com/p", "tel:123", "javascript:x", "https://sub.example.com/"]
    for row in rows[5:]:
        assert (row.title, row.internal_links, row.external_links, row.emails, row.images) == (None, [], [], [], [])


def test_rejected_references_are_counted(spark):
    df = spark.createDataFrame([(["/a", "http://[bad/", "//x]/"], "http://h/")], "hrefs array<string>, base string")
    assert df.select(extract.rejected_refs("hrefs", "base").alias("n")).first().n == 2


def test_problems_are_listed(spark):
    pages = ["<a href='/a'>", "<a href='http://[bad/'><a href='//x]/'><a href='/b'>", "<![bogus[x]]>", None]
    rows = [(i, "http://h/", html) for i, html in enumerate(pages)]
    df = read_responses(spark.createDataFrame(rows, "i int, url string, html string"))
    got = {r.i: (r.parse_error is None, r.n_rejected_refs) for r in extract.page_problems(df, ["i"]).collect()}
    assert got == {1: (True, 2), 2: (False, 0)}


def test_descriptions(spark):
    pages = [
        '<meta name="description" content=" text "><p>no</p>',
        '<meta name="description" content=" "><p>First paragraph text.</p><p>second</p>',
        "<p> </p><p>second</p>",
        "<div>none</div>",
        '<meta name="Description" content="case"><p>p</p>',
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    rows = sorted(extract.page_descriptions(df, ["i"]).collect())
    assert [r.description for r in rows] == ["text", "First paragraph text.", None, None, "p"]


def test_posts(spark):
    def og(prop, content):
        return f'<meta property="og:{prop}" content="{content}">'

    rows = [
        ("https://p/1", 200, "<title>T</title>" + og("description", " 5 likes - me_1 on May 1 ") + og("image", "/rel.jpg")),
        ("https://p/2", 200, og("image", " ") + og("image", "second.jpg") + og("title", "N (@h.2)")),
        ("https://p/3", 0, None),
        ("https://p/4", 200, None),
        ("https://p/5", 200, ""),
        ("https://p/6", 404, og("title", "solo")),
        ("https://p/7", 0, "<title>x</title>"),
    ]
    df = spark.createDataFrame(rows, "url string, status int, html string")
    posts = {r.url: r for r in extract.post_metadata(read_responses(df)).collect()}
    assert set(posts) == {"https://p/1", "https://p/2", "https://p/5", "https://p/6"}
    assert tuple(posts["https://p/1"]) == (
        "instagram_post", "https://p/1", 200, "T", "5 likes - me_1 on May 1", "/rel.jpg", "me_1",
    )
    assert posts["https://p/2"].image_url is None and posts["https://p/2"].username == "h.2"
    assert posts["https://p/5"].title == "Instagram" and posts["https://p/6"].username == "solo"


def test_a_seed_without_host_has_external_links_only(spark):
    pages = spark.createDataFrame([("http://h/", "<a href='/x'>", None)], "url string, html string, host string")
    row = extract.profile_pages(read_responses(pages), "host").first()
    assert (row.internal_links, row.external_links) == ([], ["http://h/x"])


def test_posts_are_reported_as_asked_for(spark):
    given = "https://Posts.example/p/1/?x=1#c"
    pages = spark.createDataFrame([(given, "<title>T</title>")], "url string, html string")
    assert extract.post_metadata(read_responses(pages, final_as_given=True)).first().url == given
    assert read_responses(pages).first().final_url == "https://posts.example/p/1?x=1"
