"""Main text: mark-up by example, alignment and pairing against brute force."""

import random

import pytest

from pagegraph.llm import extraction
from pagegraph.llm.extraction import LineReader, common, extract, kept_lines, line_hash, shared_places

SCHEMA = "page_id long, url string, html string, text string, k1 int, `a.b` string, places int"


def text_of(html):
    return "\n\n".join(kept_lines(LineReader().read(html), set()))


ARTICLE = "<article><h1>A &amp; B</h1><p><b>First\n &nbsp;one.<br>Still &lt;first&gt;<p>Second &#8364;.</p></article>"
WANT = "A & B\n\nFirst one. Still <first>\n\nSecond €."


@pytest.mark.parametrize(
    "html",
    [
        f"<title>t</title><nav><a href=/>Home</a></nav>{ARTICLE}<footer>&copy; me",
        f"<body class='has-sidebar'><header><h1>Site</h1></header>{ARTICLE}<aside>Also <article>teaser</article></aside>",
        f"<div class='cookie-notice'>We use cookies</div><main>{ARTICLE}<section id='comments'><article class='comment'>So true</article></section></main>",
        f"<script>if (a < b) document.write('<p>no</p>')</script><style>p{{}}</style><!-- <p>no --><form><label>Name</label></form>{ARTICLE}",
        f"<div role='navigation'>Menu</div><div id='leftSidebar'>Links</div><div class='ad'>Buy</div>{ARTICLE}<div class='site-footer'>end</div>",
        "<form id=aspnet><div class=menu>Menu</div>" + ARTICLE + "</form>",
        "<nav><ul><li>never closed</ul>" + ARTICLE,
        ARTICLE.replace("</article>", "<div class='share-buttons'>Share</div><div class='newsletter'>Join</div><footer>tags</footer></article>"),
        "<div class='menu'>Menu</div><div class='post-content'>" + ARTICLE.removeprefix("<article>").removesuffix("</article>") + "</div>",
        "<body><header>Site</header><div id='content'>" + ARTICLE.removeprefix("<article>").removesuffix("</article>") + "</div></body>",
        "<div class='nav'>x<div>y</div>z</div>" + ARTICLE.removeprefix("<article>").removesuffix("</article>"),
        "<article><header><h1>A &amp; B</h1></header><p hidden>no</p><p style='display: none'>no</p><p>First one. Still &lt;first&gt;</p><textarea>no</textarea><p>Second &euro;.</article>",
    ],
)
def test_markup(html):
    assert text_of(html) == WANT


def test_pages_without_text():
    for html in ("", " \n", "<nav>a</nav>", "<script>x", "<!-- a -->", "<p></p>"):
        assert text_of(html) == ""
    assert text_of("only words") == "only words"
    assert text_of("<form><p>All in a form</p></form>") == "All in a form"
    assert "rest" in text_of("<![if x]><p>rest</p><![bad")


def test_tables_and_lists():
    html = "<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><pre>x\n y</pre></article>"
    assert text_of(html).split("\n\n") == ["one", "two", "a", "b", "c", "x y"]


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [4, 30, 1 << 28])
def test_common_is_longest(monkeypatch, bits):
    monkeypatch.setattr(extraction, "TABLE_BITS", bits)
    rng = random.Random(bits)
    for _ in range(400):
        kinds = rng.choice([1, 2, 4, 9])
        a, b = ([rng.randrange(kinds) for _ in range(rng.randrange(15))] for _ in range(2))
        pairs = common(a, b)
        assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_common_of_long_pages():
    rng = random.Random(1)
    a = [rng.randrange(40) for _ in range(3000)]
    assert common(a, a) == [(i, i) for i in range(3000)]
    assert len(common(a, a[::2])) == 1500


def long_line(rng):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(14))


def site(rng, host, n):
    """Pages without any telling mark-up: a menu, three long lines of their own, a footer line."""
    pages = []
    for i in range(n):
        own = [long_line(rng) for _ in range(3)]
        lines = ["Home", "News", "About us", *own, "Imprint", f"(c) {host}"]
        pages.append((f"https://{host}/a/{i:03d}?x=1", own, "".join(f"<div>{t}</div>" for t in lines)))
    return pages


def expected(rows):
    """Brute force: by host, distinct pages in order of path, each against the one before and behind."""
    reader, nodes = LineReader(), {}
    for _, url, html in rows:
        hit = extraction.re.match(extraction._URL, url or "")
        if hit and hit[1]:
            lines = tuple(line_hash(t) for t, _ in reader.read(html or ""))
            nodes.setdefault(hit[1].lower(), set()).add((hit[2], lines))
    return nodes


def test_differencing(spark, tmp_path):
    rng = random.Random(3)
    pages = site(rng, "a.example", 40) + site(rng, "B.example", 7) + site(rng, "one.example", 1)
    rows = [(i, url, html) for i, (url, _, html) in enumerate(pages)]
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        df = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], SCHEMA)
        got = {r.page_id: r for r in extract(df).collect()}
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
    assert len(got) == len(rows) and got[0]["a.b"] == "clash" and got[0].places == 2
    for i, (url, own, _) in enumerate(pages):
        if "one.example" in url:
            assert got[i].n_shared == 0 and got[i].text.startswith("Home")
        else:
            assert got[i].text.split("\n\n") == own and got[i].n_shared == 5
        assert got[i].n_chars == len(got[i].text)


def test_shared_lines_against_brute_force(spark, tmp_path):
    """Counts of shared lines, whatever the ranges: more of them than pages, and a hot host."""
    rng = random.Random(4)
    words = [f"t{i}" for i in range(12)]
    rows = []
    for i in range(120):
        host = rng.choice(["hot.example"] * 3 + ["x.example", "y.example"])
        html = "".join(f"<p>{rng.choice(words)}</p>" for _ in range(rng.randrange(8)))
        rows.append((i, f"http://{host}/{rng.randrange(60)}", html))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    by_node = {}
    for host, nodes in expected(rows).items():
        from_spark = spark.createDataFrame([(host, p, list(x)) for p, x in nodes], "host string, path string, lines array<long>")
        order = [(r.path, tuple(r.lines)) for r in from_spark.orderBy("path", extraction.F.xxhash64("host", "path", "lines")).collect()]
        shared = {node: set() for node in order}
        for a, b in zip(order, order[1:]):
            in_a, in_b = shared_places(list(a[1]), list(b[1]))
            shared[a].update(in_a)
            shared[b].update(in_b)
        by_node |= {(host, *node): len(s) for node, s in shared.items()}
    reader = LineReader()
    for parts in ("3", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {r.page_id: r.n_shared for r in extract(df).collect()}
        finally:
            spark.conf.unset("spark.sql.shuffle.partitions")
        for i, url, html in rows:
            host, path = url.removeprefix("http://").split("/")
            assert got[i] == by_node[host, "/" + path, tuple(line_hash(t) for t, _ in reader.read(html))]


def test_copies_keep_their_text(spark):
    """Copies of a page next to each other are no site."""
    rng = random.Random(5)
    own = [long_line(rng) for _ in range(4)]
    html = "<p>Menu</p>" + "".join(f"<p>{t}</p>" for t in own)
    near = html.replace(own[1], own[1] + " more")
    rows = [(i, f"http://h.example/{i}", near if i == 3 else html) for i in range(6)] + [(7, "http://h.example/2", html)] * 2
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 8 and all(r.text.startswith("Menu") and own[0] in r.text for r in got)


def test_odd_pages(spark):
    """Null and bad URLs, null, empty and very long pages, repeated rows, an empty table."""
    big = "<article>" + "".join(f"<p>line {i}</p>" for i in range(30_000)) + "</article>"
    rows = [(1, None, None), (None, "no url", "<p>a</p>"), (2, "http:///x", ""), (3, "http://h/1", big), (3, "http://h/1", big), (4, "http://h/2", big), (5, "http://h/2", None), (6, "ftp://[bad", "<p>b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.n_chars, len(r.text)) for r in extract(df).collect()))
    size = len("\n\n".join(f"line {i}" for i in range(30_000)))
    assert got == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, size, size), (3, size, size), (4, size, size), (5, 0, 0), (6, 1, 1)]
    assert extract(df.limit(0)).collect() == []
