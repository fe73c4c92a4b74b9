"""The one Python step: a table of HTML pages to a table of page elements.

Catalyst has no HTML tokenizer, so pages go through the stdlib's in Arrow
batches, once, for every consumer. Only raw elements come back; resolving,
splitting, trimming and matching are left to Catalyst.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagegraph.operators.plain import FIELDS, VOID, read_plain, resolve_plain, split_refs
from pagegraph.schemas import ELEMENTS, STRINGS

# Executors get this module's code with the task and need no install of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements whose text is not shown.
UNSHOWN = frozenset(("rp", "rt", "script", "style", "template"))
# Tags whose attributes are read.
WITH_VALUES = frozenset(("a", "img", "meta"))

# Tags whose content the tokenizer may read in a mode of its own.
RAW_TEXT = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
# Tags in their plainest form, which is nearly every tag.
_PLAIN_START = re.compile(r"""<([a-z][a-z0-9]*)((?: [a-z][a-z0-9:-]*=(?:"[^"]*"|'[^']*'))*)>""")
_PLAIN_END = re.compile("</([a-z][a-z0-9]*)>")
_PLAIN_ATTRIBUTE = re.compile(r""" ([^=]+)=(?:"([^"]*)"|'([^']*)')""")

_STRINGS = pa.list_(pa.string())
_METAS = pa.list_(pa.struct([(part, pa.string()) for part in ("name", "property", "content")]))
_ARROW_TYPES = dict.fromkeys(("hrefs", "srcs", "plain_links", "linked_mails", "plain_images"), _STRINGS) | {"metas": _METAS}


def _character(name: str) -> str:
    """Character of a numeric reference such as ``64`` or ``x40``."""
    code = int(name[1:], 16) if name[0] in "xX" else int(name)
    if 0x80 <= code <= 0x9F:
        return bytes([code]).decode("cp1252", "ignore") or chr(code)
    return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else "�"


class PageReader(HTMLParser):
    """Keeps the elements of one page while the tokenizer runs over it.

    Open tags form a stack without implied ends: a tag stays open until an end
    tag of its name, or of a tag around it, arrives. Plain tags are matched here;
    all others, and everything between tags, are left to the tokenizer. A page of
    nothing but plain tags needs neither (``read_plain``).
    """

    def __init__(self, fields: Iterable[str]):
        super().__init__(convert_charrefs=False)
        self.want = frozenset(fields)
        self.want_text = bool(self.want & {"text", "at_text", "first_p", "title_raw"})
        self.plain = self.want <= FIELDS

    def read(self, html: str) -> dict:
        plain = read_plain(html, self.want) if self.plain else None
        return self.read_all(html) if plain is None else plain

    def read_all(self, html: str) -> dict:
        """All fields, tag by tag."""
        self.reset()
        self.stack, self.open, self.closed_voids = [], defaultdict(int), defaultdict(int)
        self.pending, self.unshown = [], 0
        self.hrefs, self.srcs, self.metas, self.nodes = [], [], [], []
        # Depth of the first title and first p while open; None before, -1 after.
        self.title_depth = self.p_depth = None
        self.title, self.title_children, self.p_nodes = None, defaultdict(int), []
        self.feed(html)
        self.close()
        self._end_text()
        single = max(self.title_children.values(), default=0) == 1
        return {
            "title_raw": self.title if single else None,
            "hrefs": self.hrefs,
            "srcs": self.srcs,
            "metas": self.metas,
            "text": " ".join(self.nodes) if "text" in self.want else None,
            "at_text": " ".join(n for n in self.nodes if "@" in n) if "at_text" in self.want else None,
            "first_p": "".join(self.p_nodes),
        }

    def _child(self, text: str | None) -> None:
        """Count a node that is a child of the innermost open tag of the title."""
        if self.title_depth is not None and self.title_depth >= 0:
            self.title_children[len(self.stack)] += 1
            self.title = text

    def _end_text(self, shown: bool = False) -> None:
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending = []
        self._child(text)
        if shown or not self.unshown:
            text = text.strip()
            if text:
                self.nodes.append(text)
                if self.p_depth is not None and self.p_depth >= 0:
                    self.p_nodes.append(text)

    def _hidden_node(self, text: str) -> None:
        self._end_text()
        self._child(text)

    def _open(self, tag: str, attrs: Iterable) -> None:
        if self.pending:
            self._end_text()
        self._child(None)
        if tag == "title" and self.title_depth is None:
            self.title_depth = len(self.stack)
        elif tag == "p" and self.p_depth is None:
            self.p_depth = len(self.stack)
        self.stack.append(tag)
        self.open[tag] += 1
        self.unshown += tag in UNSHOWN
        if tag in WITH_VALUES:
            values = {name: value or "" for name, value in attrs}
            if tag == "a" and "href" in values:
                self.hrefs.append(values["href"])
            elif tag == "img" and "src" in values:
                self.srcs.append(values["src"])
            elif tag == "meta":
                self.metas.append({key: values.get(key) for key in ("name", "property", "content")})

    def _close(self, tag: str) -> None:
        if self.pending:
            self._end_text()
        while self.open[tag]:
            last = self.stack.pop()
            self.open[last] -= 1
            self.unshown -= last in UNSHOWN
            if self.title_depth == len(self.stack):
                self.title_depth = -1
            if self.p_depth == len(self.stack):
                self.p_depth = -1
            if last == tag:
                break

    def updatepos(self, i, j):
        return j  # no line numbers wanted

    def parse_starttag(self, i):
        plain = _PLAIN_START.match(self.rawdata, i)
        if plain is None or plain[1] in RAW_TEXT:
            return super().parse_starttag(i)
        tag, attrs = plain[1], ()
        if tag in WITH_VALUES:
            attrs = [(name, unescape(a or b)) for name, a, b in _PLAIN_ATTRIBUTE.findall(plain[2])]
        self.handle_starttag(tag, attrs)
        return plain.end()

    def parse_endtag(self, i):
        plain = _PLAIN_END.match(self.rawdata, i)
        if plain is None or plain[1] in RAW_TEXT or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs)
        if tag in VOID:
            self._close(tag)
            self.closed_voids[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.closed_voids[tag]:
            self.closed_voids[tag] -= 1
        else:
            self._close(tag)

    def handle_data(self, data):
        if self.want_text:
            self.pending.append(data)

    def handle_entityref(self, name):
        if self.want_text:
            self.pending.append(html5.get(name + ";") or f"&{name}")

    def handle_charref(self, name):
        if self.want_text:
            self.pending.append(_character(name))

    def handle_comment(self, data):
        self._hidden_node(data)

    def handle_decl(self, decl):
        self._hidden_node(decl)

    def handle_pi(self, data):
        self._hidden_node(data)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._end_text()
            self.pending.append(data[len("CDATA["):])
            self._end_text(shown=True)
        else:
            self._hidden_node(data)


def _resolve(page: dict, base: str | None) -> None:
    """Add mail links' addresses, and links and images whose references are all plain."""
    if "hrefs" in page:
        follow, page["linked_mails"] = split_refs(page["hrefs"])
        page["plain_links"] = resolve_plain(base, follow)
        if page["plain_links"] is not None:
            page["hrefs"] = []
    if "srcs" in page:
        images = resolve_plain(base, filter(None, page["srcs"]))
        page["plain_images"] = sorted(images) if images is not None else None


def _read_pages(fields: Sequence[str], keep: Sequence[str], made: Sequence[str], base_url: str | None):
    """Arrow batches of ``html`` and kept columns to batches of kept columns and elements."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = PageReader(fields)
        for batch in batches:
            found = {field: [] for field in (*fields, *made)}
            errors = []
            bases = batch.column(base_url).to_pylist() if made else None
            # One batch's pages at a time, bounded by ``arrow.maxBytesPerBatch``.
            for row, html in enumerate(batch.column("html").to_pylist()):
                page, error = {}, None
                if html:
                    try:
                        page = reader.read(html)
                    except (AssertionError, ValueError) as refused:
                        error = str(refused)
                    if made and page:
                        _resolve(page, bases[row])
                errors.append(error)
                for field, values in found.items():
                    values.append(page.get(field))
            columns = {name: batch.column(name) for name in keep}
            for field, values in found.items():
                columns[field] = pa.array(values, _ARROW_TYPES.get(field, pa.string()))
            columns["parse_error"] = pa.array(errors, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return read


#: What plain references are resolved to, by the field that has them.
RESOLVED = {"hrefs": ("plain_links", "linked_mails"), "srcs": ("plain_images",)}


def extract_elements(
    responses: DataFrame,
    fields: Sequence[str] = tuple(ELEMENTS),
    keep: Sequence[str] | None = None,
    base_url: str | None = None,
) -> DataFrame:
    """Read every page once; give the ``keep`` columns, one column per field, and
    ``parse_error``: the tokenizer's message for a page it refused.

    ``html`` goes in and does not come out. A page without body, or refused, has
    NULL in every field. With ``base_url``, one of ``keep``, come ``plain_links`` and
    ``plain_images`` of ``hrefs`` and ``srcs``: what ``page_links`` and ``page_images`` make
    of them, or NULL where a reference is not plain; ``linked_mails`` is what ``mailto_emails``
    makes of ``hrefs``, which stays only where ``plain_links`` is NULL.
    """
    unknown = set(fields) - set(ELEMENTS)
    if unknown:
        raise ValueError(f"no such page field: {sorted(unknown)}")
    if keep is None:
        keep = [c for c in responses.columns if c != "html"]
    made = [name for field in fields for name in RESOLVED.get(field, ())] if base_url else []
    narrow = responses.select(*keep, "html")
    schema = T.StructType(
        [narrow.schema[c] for c in keep]
        + [T.StructField(field, ELEMENTS[field]) for field in fields]
        + [T.StructField(field, STRINGS) for field in made]
        + [T.StructField("parse_error", T.StringType())]
    )
    return narrow.mapInArrow(_read_pages(fields, keep, made, base_url), schema)
