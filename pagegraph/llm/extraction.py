"""Main text of pages by differencing against the pages of nearest URL.

A page is read as lines, one a block of text, each with a level by its mark-up: within
an article, within the main part, open, or part of what is no article (menus, forms ...).
The pages of a host are put in the order of their URL paths; each is aligned with the one
before and the one behind it by the longest common subsequence of their lines.
Lines that a page shares so belong to the site and are deleted where the mark-up leaves
open whose they are. Lines of an article are counted when shared, not deleted: articles repeat
each other's passages.

Only hashes of lines are sorted and aligned, so no HTML is sorted. Pages are dealt out by
range of host and path, whatever the number of a host's pages; the two pages at the ends of
a range meet their neighbours of the next ranges in a second, small step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.llm.common import free_name, named, sliced
from pagegraph.session import Staging

# Levels of a line: what its mark-up says.
ARTICLE, MAIN, OPEN, FORM, OTHER = 2, 1, 0, -1, -2

#: A part that is marked as the article, or as the main one, is taken for it when it has this share of the text.
LEAST_SHARE = 0.25
#: Lines of so many words tell copies of a page from pages of one site ...
LONG_LINE = 10
#: ... which are copies when they share more than this part of such lines.
COPY_SHARE = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("head script style template noscript svg math object iframe canvas audio video map textarea select datalist button".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "script search section style summary table tbody td tfoot th thead title tr ul".split()
)
#: Tags that end an open one of the named kinds, up to the next tag around them that holds such.
ENDS = {t: ("p",) for t in BREAKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "caption"}}
ENDS |= {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDERS = BREAKS - {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

#: Tags, roles and words of class names or ids of what is not part of an article. Those of the
#: second kind stay so even around an article.
SIDE_TAGS = frozenset("nav menu header dialog search".split())
SIDE_TAGS_FIRM = frozenset("aside footer".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
SIDE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager sitemap skip masthead banner "
    "footer colophon copyright sidebar aside rail widget widgets related recommended recommendations trending popular "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
    "social share sharing".split()
)
SIDE_WORDS_FIRM = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Words that say a name is about the page as a whole.
ABOUT = frozenset("has with no without is".split())
ARTICLE_NAMES = frozenset(
    "articlebody article-body article-content article-text post-body post-content post-text entry-content story-body".split()
)
MAIN_NAMES = frozenset("content main maincontent main-content page-content primary-content".split())

_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _level(tag: str, attrs: list, around: tuple[int, bool]) -> tuple[int, bool]:
    """Level within a tag, and whether an article inside could still raise it."""
    level, firm = around
    values = {k: v or "" for k, v in attrs} if attrs else {}
    names = " ".join((values.get("class", ""), values.get("id", ""))).split()
    role = values.get("role", "").strip().lower()
    page = tag in ("html", "body")
    words = [_PARTS.split(_CAMEL.sub("-", name).lower()) for name in names] if not page else []
    words = {w for parts in words if ABOUT.isdisjoint(parts) for w in parts}
    hidden = "hidden" in values or "display:none" in values.get("style", "").replace(" ", "").lower()
    if tag in UNREAD or tag in SIDE_TAGS_FIRM or hidden or words & SIDE_WORDS_FIRM:
        return OTHER, True
    if firm:
        return around
    is_main = tag == "main" or role == "main"
    if (tag in SIDE_TAGS and not (tag == "header" and level > OPEN)) or role in SIDE_ROLES or (words & SIDE_WORDS and not is_main):
        return OTHER, False
    if (words & {"header"}) and level <= OPEN and tag not in ("article", "main", "h1"):
        return OTHER, False
    lowered = {name.lower() for name in names} if not page else set()
    if tag == "article" or role == "article" or values.get("itemprop", "").lower() == "articlebody" or lowered & ARTICLE_NAMES:
        return ARTICLE, False
    if is_main or lowered & MAIN_NAMES:
        return max(level, MAIN), False
    if tag == "form" or role == "form":
        return min(level, FORM) if level <= OPEN else OTHER, False
    return around


class LineReader(HTMLParser):
    """The lines of a page with their levels, as the tokenizer runs over it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)

    def updatepos(self, i, j):
        return j  # no line numbers wanted

    def read(self, html: str) -> list[tuple[str, int]]:
        for attempt in (html, html.replace("<!", "&lt;!")):
            self.reset()
            self.stack: list[tuple[str, tuple[int, bool]]] = []
            self.state = (OPEN, False)
            self.lines, self.pending = [], []
            try:
                self.feed(attempt)
                self.close()
                break
            except (AssertionError, ValueError):
                continue  # a declaration it can't read: taken as text
        self._end_line()
        return self.lines

    def _end_line(self) -> None:
        if self.pending:
            text = " ".join("".join(self.pending).split())
            if text:
                self.lines.append((text, self.pending_level))
            self.pending = []

    def _pop_to(self, at: int) -> None:
        del self.stack[at:]
        self.state = self.stack[-1][1] if self.stack else (OPEN, False)

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS:
            self._end_line()
        elif tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        ended = ENDS.get(tag)
        if ended:
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at][0] in ended:
                    self._pop_to(at)
                    break
                if self.stack[at][0] in HOLDERS:
                    break
        around = self.state
        if attrs or tag in _TOLD:
            self.state = _level(tag, attrs, around)
            if self.state[0] != around[0]:
                self._end_line()
        self.stack.append((tag, self.state))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BREAKS:
            self._end_line()
        for at in range(len(self.stack) - 1, -1, -1):
            own = self.stack[at][0]
            if own == tag:
                if self.stack[at][1][0] != (self.stack[at - 1][1][0] if at else OPEN):
                    self._end_line()
                self._pop_to(at)
                return
            if own in HOLDERS and tag not in HOLDERS:
                return

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] in UNREAD:
            return
        level = self.state[0]
        if not self.pending:
            self.pending_level = level
        self.pending.append(data)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])


_TOLD = UNREAD | SIDE_TAGS | SIDE_TAGS_FIRM | {"article", "main", "form"}


def kept_lines(lines: list[tuple[str, int]], shared: set[int]) -> list[str]:
    """The article's lines: of the best level that has its share, less those shared with other pages."""
    sizes = {level: sum(len(t) for t, own in lines if own == level) for level in (ARTICLE, MAIN, OPEN)}
    whole = sum(sizes.values())
    if not whole:
        return [t for t, own in lines if own == FORM]
    least = OPEN
    if sizes[ARTICLE] and sizes[ARTICLE] >= LEAST_SHARE * whole:
        least = ARTICLE
    elif sizes[ARTICLE] + sizes[MAIN] and sizes[ARTICLE] + sizes[MAIN] >= LEAST_SHARE * whole:
        least = MAIN
    return [t for i, (t, own) in enumerate(lines) if own >= least and (own == ARTICLE or i not in shared)]


# -- alignment -------------------------------------------------------------

#: Bits of the table of one alignment held at once; a larger one is halved.
TABLE_BITS = 1 << 28


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Row by row of the table of common subsequences: bit j is 0 where the length grows at b[j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    yield row
    for x in a:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & full
        yield row


def _lengths(row: int, n: int) -> np.ndarray:
    """Common length for each number of leading items of b."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence, in order."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head = [(i, i) for i in range(start)]
    tail = [(len(a) - end + i, len(b) - end + i) for i in range(end)]
    inner = _aligned(a[start : len(a) - end], b[start : len(b) - end])
    return head + [(i + start, j + start) for i, j in inner] + tail


def _aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    if not a or not b or set(a).isdisjoint(b):
        return []
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2
        for row in _rows(a[:half], b):
            first = row
        for row in _rows(a[:half - 1 : -1], b[::-1]):
            last = row
        cut = int((_lengths(first, len(b)) + _lengths(last, len(b))[::-1]).argmax())
        behind = _aligned(a[half:], b[cut:])
        return _aligned(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in behind]
    rows = list(_rows(a, b))
    i, j, pairs = len(a), len(b), []
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
            continue
        below = (1 << j) - 1
        if (rows[i - 1] & below).bit_count() == (rows[i] & below).bit_count():
            i -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def line_hash(text: str) -> int:
    """64 bits of a line's text, the lowest one telling whether it is long."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1
    return value & ~1 | (text.count(" ") + 1 >= LONG_LINE)


def _is_copy(hashes: list[int], places: list[int]) -> bool:
    long = sum(h & 1 for h in hashes)
    return sum(hashes[i] & 1 for i in places) > COPY_SHARE * long


def shared_places(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places of the lines two pages share; none where one of them is a copy of the other."""
    pairs = common(a, b)
    in_a, in_b = [i for i, _ in pairs], [j for _, j in pairs]
    if _is_copy(a, in_a) or _is_copy(b, in_b):
        return [], []
    return in_a, in_b


# -- over a table ----------------------------------------------------------

_URL = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"


def _with_lines(pages: DataFrame) -> DataFrame:
    """``k1, k2, host, path`` and the hashes of the ``lines`` of each page (``html`` in, not out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = LineReader()
        for batch in batches:
            for part in sliced(batch, 0):
                hashes = [[line_hash(t) for t, _ in reader.read(html or "")] for html in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(hashes, pa.list_(pa.int64()))], names=["k1", "k2", "host", "path", "lines"])

    return pages.select("html", "k1", "k2", "host", "path").mapInArrow(run, "k1 long, k2 long, host string, path string, lines array<long>")


_FOUND = "node long, places array<int>"
_ENDS = _FOUND + ", part int, last boolean, host string, lines array<long>"


def _pair_ranges(nodes: DataFrame) -> DataFrame:
    """Each page of a sorted range with the ``places`` of lines it shares with its neighbours
    in the range, and, for the pages at the range's ends, what the next ranges need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, first = None, True
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = [*row, set()]
                if before is None:
                    out.append((page[0], [], part, False, page[1], page[2]))
                else:
                    if before[1] == page[1]:
                        a, b = shared_places(before[2], page[2])
                        before[3].update(a)
                        page[3].update(b)
                    out.append((before[0], sorted(before[3]), None, None, None, None))
                before = page
            yield _batch(out)
        if before is not None:
            yield _batch([(before[0], sorted(before[3]), part, True, before[1], before[2])])

    return nodes.mapInArrow(run, _ENDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.int64())]
    names = ["node", "places", "part", "last", "host", "lines"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _pair_ends(ends: DataFrame) -> DataFrame:
    """Places shared by the last page of a range and the first of the next one: two rows a range."""
    order = Window.partitionBy("host").orderBy("part", "last")
    ahead = ends.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("node", "lines", "last")})
    pairs = ahead.filter("last AND NOT next_last").select("node", "lines", "next_node", "next_lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, places = [], []
            for a, lines_a, b, lines_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes += [a, b]
                places += shared_places(lines_a, lines_b)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(places, pa.list_(pa.int32()))], names=["node", "places"])

    return pairs.mapInArrow(run, _FOUND)


def shared_with_nearest(lined: DataFrame, staging: Staging) -> DataFrame:
    """``k1, k2, places``: of pages (``k1, k2, host, path, lines``) the lines shared with the
    page before or behind in the host's order of paths. Pages that share none are left out.

    Pages of one path with the same lines count as one; a page without host has no neighbours.
    """
    placed = lined.filter("host IS NOT NULL").withColumn("node", F.xxhash64("host", "path", "lines"))
    nodes = placed.groupBy("host", "path", "node").agg(F.first("lines").alias("lines"))
    ranges = int(lined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(ranges, "host", "path", "node").sortWithinPartitions("host", "path", "node")
    paired = staging.keep(_pair_ranges(ranged.select("node", "host", "lines")), "paired")
    ends = paired.filter("part IS NOT NULL").select("node", "part", "last", "host", "lines")
    found = paired.select("node", "places").unionByName(_pair_ends(ends)).filter("size(places) > 0")
    by_node = found.groupBy("node").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    return placed.select("k1", "k2", "node").distinct().join(by_node, "node").select("k1", "k2", "places")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without HTML, and with ``text`` (its blocks, two line ends between), ``n_chars`` and
    ``n_shared``, the number of lines that a page shares with its nearest ones.

    Every row comes out, in place of columns named like the new ones. A null or empty page, and one
    without article, has an empty text. A page without host, or alone on it, is told by its mark-up.
    Equal URLs with equal pages have equal results.
    """
    staging = Staging(pages.sparkSession)
    known = {html_col, "text", "n_chars", "n_shared"}
    kept = [c for c in pages.columns if c not in known]
    spare = [free_name(kept, n) for n in ("html", "k1", "k2", "places")]
    url, html = named(url_col), named(html_col)
    keys = {spare[1]: F.xxhash64(url, html), spare[2]: F.xxhash64(F.lit("page"), html, url)}
    keyed = pages.select(*[named(c) for c in kept], html.alias(spare[0]), *[c.alias(n) for n, c in keys.items()])
    host = F.lower(F.nullif(F.regexp_extract(url, _URL, 1), F.lit("")))
    to_read = pages.select(html.alias("html"), keys[spare[1]].alias("k1"), keys[spare[2]].alias("k2"), host.alias("host"), F.regexp_extract(url, _URL, 2).alias("path"))
    lined = staging.keep(_with_lines(to_read), "page-lines")
    shared = Staging(pages.sparkSession).keep(shared_with_nearest(lined, staging), "page-shared")
    staging.drop()
    met = keyed.join(shared.toDF(*spare[1:]), spare[1:3], "left").select(*[named(c) for c in [spare[0], spare[3], *kept]])
    return _texts(met, kept)


def _texts(met: DataFrame, kept: list[str]) -> DataFrame:
    new = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_shared", T.LongType())]
    out = T.StructType(met.schema.fields[2:] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = LineReader()
        for batch in batches:
            for part in sliced(batch, 0):
                shared = [set(p or ()) for p in part.column(1).to_pylist()]
                texts = ["\n\n".join(kept_lines(reader.read(html or ""), s)) for html, s in zip(part.column(0).to_pylist(), shared, strict=True)]
                columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, shared), pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], *columns], names=[*part.schema.names[2:], "text", "n_chars", "n_shared"])

    plain = met.toDF(*[f"c{i}" for i in range(len(met.columns))])
    shape = T.StructType([T.StructField(f"c{i + 2}", f.dataType) for i, f in enumerate(out.fields[:-3])] + new)
    return plain.mapInArrow(run, shape).toDF(*out.names)


def op13_nearest_url_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``; nulls and ties as told by ``extract``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages).select("page_id", "url", "text", "n_chars", "n_shared")
