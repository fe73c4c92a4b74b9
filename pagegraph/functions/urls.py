"""URL resolution and canonical form as Catalyst expressions.

Functions take column names or other SQL text and give a ``Column`` of built-ins.
A URL is split with the pattern of RFC 3986 appendix B. Every step binds its
result with ``transform``, so no part is worked out twice for one URL, and the
whole is handed to Spark as one text, so a plan over it is quick to build.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scheme classes of the public URL rules this follows.
RELATIVE_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
NETLOC_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
    "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp",
    "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)
DEFAULT_PORTS = {"http": ":80", "https": ":443"}
# Characters whose NFKC form holds one of / ? # @ : and so may hide a delimiter.
HIDDEN_DELIMITERS = "⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠"

_SCHEME = r"(?:([A-Za-z][A-Za-z0-9+.\-]*):)?"
_NETLOC = r"(?://([^/?#]*))?"
_UP_TO_NETLOC = rf"^{_SCHEME}{_NETLOC}"
_UP_TO_PATH = rf"{_UP_TO_NETLOC}([^?#]*)"
_UP_TO_QUERY = r"^[^?#]*\?([^#]*)"
_FRAGMENT = r"#([\s\S]*)"
_EMPTY_PARAMS = r"((?:^|/)[^;/]*);\z"
_DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|\z)"
_IPV6 = (
    r"(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}"
    r"|(?:[0-9a-f]{1,4}:){6}[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
    r"|(?![0-9a-f:]*::[0-9a-f:]*::)(?!(?::?:?[0-9a-f]{1,4}){8})"
    r"(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?::"
    r"(?:(?:[0-9a-f]{1,4}:)*(?:[0-9a-f]{1,4}|[0-9]{1,3}(?:\.[0-9]{1,3}){3}))?)"
)
# A web URL of a bare host and a bare path that is the root or has no slash at its end.
_CANONICAL = r"^https?://[a-z0-9.-]+/(?:[A-Za-z0-9_.~/-]*[A-Za-z0-9_.~-])?\z"
_BRACKETED = rf"(?i)^[^\[]*\[(?:v[0-9a-f]+\.[^\]]+|{_IPV6}(?:%[^%\]]+)?)\]"




def _one_of(value: str, known: tuple[str, ...]) -> str:
    """SQL of a membership test with a single literal."""
    return f"find_in_set({value}, '{','.join(known)}') > 0"


def _bound(value: str, name: str, use: str) -> str:
    """SQL of ``use`` with ``name`` standing for ``value``, worked out once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _cleaned(url: str) -> str:
    return rf"regexp_replace({url}, r'^[\x00-\x20]+|[\t\r\n]', '')"


def _split(url: str) -> str:
    """Scheme, host, path with parameters, and query of a cleaned URL."""
    return (
        f"named_struct('scheme', lower(regexp_extract({url}, r'{_UP_TO_NETLOC}', 1)),"
        f" 'netloc', regexp_extract({url}, r'{_UP_TO_NETLOC}', 2),"
        f" 'path', regexp_extract({url}, r'{_UP_TO_PATH}', 3),"
        f" 'query', if(contains({url}, '?'), regexp_extract({url}, r'{_UP_TO_QUERY}', 1), ''))"
    )


def _is_bad_netloc(netloc: str) -> str:
    """Brackets that hold no IP literal, or a character that hides a delimiter."""
    bracketed = f"((contains({netloc}, '[') or contains({netloc}, ']')) and not {netloc} rlike r'{_BRACKETED}')"
    hidden = f"(length({netloc}) <> octet_length({netloc}) and {netloc} rlike r'[{HIDDEN_DELIMITERS}]')"
    return f"({netloc} <> '' and ({bracketed} or {hidden}))"


def _without_params(scheme: str, path: str) -> str:
    cut = rf"regexp_replace({path}, r';[^/]*\z', '')"
    return f"if(contains({path}, ';') and {_one_of(scheme, PARAM_SCHEMES)}, {cut}, {path})"


def _without_default_port(scheme: str, netloc: str) -> str:
    cases = " ".join(
        f"when {scheme} = '{known}' and endswith({netloc}, '{port}')"
        f" then left({netloc}, length({netloc}) - {len(port)})"
        for known, port in DEFAULT_PORTS.items()
    )
    return f"case {cases} else {netloc} end"


def _plain_path(path: str) -> str:
    """Root for an empty path; one trailing slash less for any other."""
    return (
        f"case when {path} in ('', '/') then '/'"
        f" when endswith({path}, '/') then left({path}, length({path}) - 1) else {path} end"
    )


def _written(p: str) -> str:
    """URL of its parts."""
    path = f"{p}.path"
    rooted = f"({path} = '' or startswith({path}, '/'))"
    body = (
        f"case when {p}.netloc <> '' then concat('//', {p}.netloc, if({rooted}, '', '/'), {path})"
        f" when startswith({path}, '//') then concat('//', {path})"
        f" when {p}.scheme <> '' and {rooted} and {_one_of(f'{p}.scheme', NETLOC_SCHEMES)}"
        f" then concat('//', {path}) else {path} end"
    )
    return (
        f"concat(if({p}.scheme = '', '', concat({p}.scheme, ':')), {body},"
        f" if({p}.query = '', '', concat('?', {p}.query)))"
    )


def _canonical_parts(p: str) -> str:
    """Canonical form of split parts; NULL when the host is not valid."""
    parts = (
        f"named_struct('scheme', {p}.scheme, 'netloc', lower({p}.netloc),"
        f" 'path', {_without_params(f'{p}.scheme', f'{p}.path')}, 'query', {p}.query)"
    )
    plain = (
        f"named_struct('scheme', b.scheme, 'netloc', {_without_default_port('b.scheme', 'b.netloc')},"
        f" 'path', {_plain_path('b.path')}, 'query', b.query)"
    )
    return f"if({_is_bad_netloc(f'{p}.netloc')}, null, {_bound(parts, 'b', plain)})"


def _without_dot_segments(path: str) -> str:
    """Path with ``.`` and ``..`` segments worked in; never empty."""
    step = (
        "case when seg = '.' then done"
        " when seg = '..' then slice(done, 1, greatest(size(done) - 1, 0))"
        " else array_append(done, seg) end"
    )
    walked = f"aggregate(split({path}, '/'), cast(array() as array<string>), (done, seg) -> {step})"
    closing = rf"if({path} rlike r'(?:^|/)\.\.?\z', array(''), cast(array() as array<string>))"
    whole = f"array_join(concat({walked}, {closing}), '/')"
    return _bound(f"if({path} rlike r'{_DOT_SEGMENT}', {whole}, {path})", "plain", "if(plain = '', '/', plain)")


def _base_parts(base: str) -> str:
    """Split base URL with the folder that relative paths start from."""
    bare = _without_params("s.scheme", "s.path")
    folder = r"if(bare = '', '/', regexp_extract(bare, r'^(?:[\s\S]*/)?', 0))"
    parts = (
        f"named_struct('scheme', s.scheme, 'netloc', s.netloc, 'path', s.path, 'query', s.query,"
        f" 'folder', {_bound(bare, 'bare', folder)}, 'bad', {_is_bad_netloc('s.netloc')})"
    )
    return _bound(_bound(_cleaned(base), "c", _split("c")), "s", parts)


def _resolved_parts(base: str, ref: str) -> str:
    """Parts of a split reference seen from a split base."""
    scheme = f"if({ref}.scheme = '', {base}.scheme, {ref}.scheme)"
    known = _bound(
        scheme,
        "sch",
        f"named_struct('scheme', sch, 'ref', {ref}, 'no_path', {ref}.path in ('', ';'), 'absolute',"
        f" sch <> {base}.scheme or not {_one_of('sch', RELATIVE_SCHEMES)})",
    )
    own_host = "(k.absolute or k.ref.netloc <> '')"
    rooted = f"if(startswith(k.ref.path, '/'), k.ref.path, regexp_replace(concat({base}.folder, k.ref.path), '/+', '/'))"
    # Dot segments are worked in before the parameters of the last one.
    with_params = f"concat({_without_dot_segments('bare')}, substring(whole, length(bare) + 1))"
    merged = (
        f"if(contains(whole, '.') or contains(whole, ';'),"
        f" {_bound(_without_params('k.scheme', 'whole'), 'bare', with_params)}, whole)"
    )
    parts = (
        f"named_struct('scheme', if(k.absolute, k.ref.scheme, k.scheme),"
        f" 'netloc', if({own_host}, k.ref.netloc, {base}.netloc),"
        f" 'path', case when {own_host} then k.ref.path when k.no_path then {base}.path"
        f" else {_bound(rooted, 'whole', merged)} end,"
        f" 'query', if(k.ref.query = '' and k.no_path and not {own_host}, {base}.query, k.ref.query),"
        f" 'bad', {_is_bad_netloc('k.ref.netloc')} or {base}.bad, 'passed_on', k.absolute)"
    )
    return _bound(known, "k", parts)


def normalize_url(url: str) -> Column:
    """Canonical form: lower-case scheme and host, no default port, no fragment,
    no path parameters, no trailing slash. NULL when the host is not valid."""
    split = _bound(_cleaned(url), "c", _split("c"))
    whole = _bound(_bound(split, "s", _canonical_parts("s")), "p", _written("p"))
    # Nearly every URL of a crawl is canonical as it comes; one match tells.
    return F.expr(f"if({url} rlike r'{_CANONICAL}', {url}, {whole})")


def canonical_netloc(url: str) -> str:
    """SQL of the host part of a URL already in canonical form."""
    return f"regexp_extract({url}, r'{_UP_TO_NETLOC}', 2)"


def netloc(url: str) -> Column:
    """Host part as written, with port and user."""
    return F.expr(canonical_netloc(_cleaned(url)))


def same_host(url: str, seed_netloc: str) -> Column:
    return F.expr(f"lower({canonical_netloc(_cleaned(url))}) = lower({seed_netloc})")


def resolve_url(base: str, ref: str) -> Column:
    """Absolute URL of ``ref`` seen from ``base``, fragment kept. A URL of another
    scheme, or a blank base or reference, is passed on as it is."""
    # Columns are named outside the lambdas only, so no name can be taken for theirs.
    given = f"named_struct('base', {base}, 'ref', {ref})"
    whole = (
        f"named_struct('scheme', w.scheme, 'netloc', w.netloc, 'query', w.query, 'path',"
        f" if({_one_of('w.scheme', PARAM_SCHEMES)}, regexp_replace(w.path, r'{_EMPTY_PARAMS}', '$1'), w.path))"
    )
    fragment = _bound(
        f"regexp_extract({_cleaned('g.ref')}, r'{_FRAGMENT}', 1)", "f", "if(f = '', '', concat('#', f))"
    )
    joined = f"concat({_bound(whole, 'p', _written('p'))}, {fragment})"
    outcome = f"case when w.bad then null when w.passed_on then g.ref else {joined} end"
    split = _bound(_cleaned("g.ref"), "c", _split("c"))
    resolved = _bound(split, "r", _resolved_parts("b", "r"))
    seen = _bound(_base_parts("g.base"), "b", _bound(resolved, "w", outcome))
    return F.expr(
        _bound(given, "g", f"case when g.base = '' then g.ref when g.ref = '' then g.base else {seen} end")
    )


def canonical_refs_sql(base: str, refs: str) -> str:
    given = f"named_struct('base', {_base_parts(base)}, 'refs', {refs})"
    split = f"transform(transform(g.refs, x -> {_cleaned('x')}), c -> {_split('c')})"
    resolved = f"transform({split}, r -> {_resolved_parts('g.base', 'r')})"
    valid = f"transform({resolved}, w -> if(w.bad, null, {_canonical_parts('w')}))"
    return _bound(given, "g", f"transform({valid}, p -> {_written('p')})")


def canonical_refs(base: str, refs: str) -> Column:
    """Canonical absolute URL of every reference of an array, in order; NULL where
    the host is not valid."""
    return F.expr(canonical_refs_sql(base, refs))


def canonicalize_urls(df: DataFrame, url_col: str, base_col: str | None = None) -> DataFrame:
    """Add ``canonical_url`` and ``netloc`` to a table of URLs."""
    if base_col is not None:
        df = df.withColumn("canonical_url", resolve_url(base_col, url_col))
    else:
        df = df.withColumn("canonical_url", F.col(url_col))
    with_url = df.withColumn("canonical_url", normalize_url("canonical_url"))
    return with_url.withColumn("netloc", netloc("canonical_url"))
