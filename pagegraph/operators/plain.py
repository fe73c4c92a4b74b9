"""Plain pages and plain references, read by a few patterns each.

Nearly all pages and references are of the simplest form. A page in which every tag is
plain needs no stack of open tags, and a reference of letters, digits and slashes no
splitting; both are told apart by one match. Whatever does not match is left, whole, to
the tokenizer and to ``functions.urls``, which give the same for the plain ones.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from html import unescape

from pyspark import cloudpickle

# As for the page reader: executors need no install of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content. An end tag of theirs may or may not part a text.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Tags whose content is read in a mode of its own, or not shown.
_ODD = "iframe|noembed|noframes|noscript|plaintext|script|style|textarea|title|xmp|rp|rt|template"
# None of those begins with one of the letters named first, so most tags are told by a letter.
_TAG = rf"(?:[abcdefghjklmoquvwyz][a-z0-9]*+|(?!(?:{_ODD})[ >])[a-z][a-z0-9]*+)"
_END = rf"(?!(?:{'|'.join(sorted(VOID))})>){_TAG}"
_ATTRIBUTES = r"""((?: [a-z][a-z0-9:-]*=(?:"[^"<>]*"|'[^'<>]*'))*+)"""
_NO_GROUP = _ATTRIBUTES.replace("((?:", "(?:(?:", 1)
_TEXT = r"[^<>&]|&(?:amp|lt|gt|quot);"
_HIDDEN = rf"<(?:script{_NO_GROUP}>(?:[^<]|<(?![/!]))*+</script>|style{_NO_GROUP}>(?:[^<]|<(?![/!]))*+</style>)"
_PAGE = re.compile(
    rf"(?=<)(?:<{_TAG}{_NO_GROUP}>|</{_END}>|[^<>&]++|{_TEXT}|<title>(?:{_TEXT})*+</title>|{_HIDDEN}|<!DOCTYPE html>)*+"
)
_HIDDEN_PARTS = re.compile(_HIDDEN)
_TITLE = re.compile("<title>([^<]*)</title>")
_NODE = re.compile(">([^<]+)")
_AT_NODE = re.compile(">([^<@]*@[^<]*)")
_ATTRIBUTE = re.compile(r""" ([^=]+)=(?:"([^"]*)"|'([^']*)')""")
# A tag with the one attribute wanted, and with any.
_SOLE = {
    (tag, name): re.compile(rf"""<{tag} {name}=(?:"([^"]*)"|'([^']*)')>""") for tag, name in (("a", "href"), ("img", "src"))
}
_WITH_ANY = {tag: re.compile(rf"<{tag}{_ATTRIBUTES}>") for tag in ("a", "img", "meta")}

#: Fields read of a plain page.
FIELDS = frozenset(("title_raw", "hrefs", "srcs", "metas", "text", "at_text"))


def _attributes(html: str, tag: str) -> list[dict]:
    return [{name: unescape(a or b) for name, a, b in _ATTRIBUTE.findall(found)} for found in _WITH_ANY[tag].findall(html)]


def _values(html: str, tag: str, name: str) -> list[str]:
    found = _SOLE[tag, name].findall(html)
    if len(found) == html.count(f"<{tag} "):
        return [unescape(value) if "&" in (value := a or b) else value for a, b in found]
    return [values[name] for values in _attributes(html, tag) if name in values]


def _nodes(html: str, pattern: re.Pattern) -> str:
    return " ".join(filter(None, (unescape(node).strip() for node in pattern.findall(html))))


def read_plain(html: str, want: frozenset) -> dict | None:
    """The wanted fields of a plain page; None if it is not plain."""
    if _PAGE.fullmatch(html) is None:
        return None
    if "<s" in html:
        # What stands there is no text, but parts the text around it.
        html = _HIDDEN_PARTS.sub("<br>", html)
    page = {}
    if "title_raw" in want:
        title = _TITLE.search(html)
        page["title_raw"] = unescape(title[1]) if title and title[1] else None
    if "hrefs" in want:
        page["hrefs"] = _values(html, "a", "href")
    if "srcs" in want:
        page["srcs"] = _values(html, "img", "src")
    if "metas" in want:
        page["metas"] = [{key: m.get(key) for key in ("name", "property", "content")} for m in _attributes(html, "meta")]
    if "text" in want:
        page["text"] = _nodes(html, _NODE)
    if "at_text" in want:
        page["at_text"] = _nodes(html, _AT_NODE) if "@" in html else ""
    return page


_SEGMENT = r"[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)*+"
_BASE = re.compile(rf"(https?)(://[a-z0-9-][a-z0-9.-]*)((?:/{_SEGMENT})*/?)")
# Scheme, host, port and path of an absolute reference, or path of one from the root, or the
# way up and path of a relative one; then the query. A line each.
_REFERENCE = re.compile(
    rf"^(?:(https?)(://[A-Za-z0-9-][A-Za-z0-9.-]*)(:[0-9]+)?((?:/{_SEGMENT})*+)/?"
    rf"|(?=/)((?:/{_SEGMENT})*+)/?|(\.\.?/)?({_SEGMENT}(?:/{_SEGMENT})*+)/?)"
    r"(\?[A-Za-z0-9_=&%+.-]+)?(?:#[!-~]*+)?$",
    re.M,
)
_PORTS = {"http": ":80", "https": ":443"}


def resolve_plain(base: str | None, refs: Iterable[str]) -> list[str] | None:
    """Canonical form of every reference seen from ``base``, each once in order; None if one
    of them, or the base, is not plain."""
    refs = list(refs)
    if not refs:
        return []
    split = _BASE.fullmatch(base or "")
    lines = "\n".join(refs)
    if split is None or lines.count("\n") != len(refs) - 1:
        return None
    parts = _REFERENCE.findall(lines)
    if len(parts) != len(refs):
        return None
    host = split[1] + split[2]
    folder = host + (split[3][: split[3].rfind("/") + 1] or "/")
    found: dict[str, None] = {}
    for scheme, named, port, path, rooted, up, relative, query in parts:
        if scheme:
            if port and port == _PORTS[scheme]:
                port = ""
            found[f"{scheme}{named.lower()}{port}{path or '/'}{query}"] = None
        elif relative:
            start = folder
            if up == "../":
                start = folder[: folder.rfind("/", 0, -1) + 1]
                if len(start) <= len(host):
                    return None
            found[start + relative + query] = None
        else:
            found[f"{host}{rooted or '/'}{query}"] = None
    return list(found)


def split_refs(hrefs: list[str]) -> tuple[list[str], list[str]]:
    """References to follow, and the addresses of mail links; blank ones and scripts are neither."""
    follow, mails = [], []
    for href in hrefs:
        start = href[:11].lower() if href[:1] in "mMjJ" else href
        if start.startswith("mailto:"):
            mails.append(href[7:].split("?", 1)[0].strip())
        elif start and start != "javascript:":
            follow.append(href)
    return follow, [mail for mail in mails if mail]
