"""Page facts from page elements, all in Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.functions.text import blank_to_null, emails_in, post_username, trim_unicode
from pagegraph.functions.urls import canonical_netloc, canonical_refs_sql
from pagegraph.operators.counts import Counts, how_many, watched
from pagegraph.operators.elements import extract_elements

# Link schemes left out, and the words a post row uses.
MAILTO = "mailto:"
JAVASCRIPT = "javascript:"
POST_KIND = "instagram_post"
POST_TITLE = "Instagram"


NO_STRINGS = "cast(array() as array<string>)"


def page_title(title_raw: Column) -> Column:
    return blank_to_null(trim_unicode(title_raw))


def followable(hrefs: str) -> str:
    """References that are not blank, mail addresses or scripts."""
    return (
        f"filter({hrefs}, h -> h <> '' and not startswith(lower(h), '{MAILTO}')"
        f" and not startswith(lower(h), '{JAVASCRIPT}'))"
    )


def page_links(hrefs: str, base_url: str) -> Column:
    """Canonical links in document order, each where it first occurs. References
    without a valid host are left out; ``rejected_refs`` counts them."""
    found = canonical_refs_sql(base_url, followable(hrefs))
    return F.expr(f"coalesce(array_distinct(array_compact({found})), {NO_STRINGS})")


def rejected_refs(hrefs: str, base_url: str) -> Column:
    """Number of references left out because their host is not valid."""
    return F.expr(f"size(filter({canonical_refs_sql(base_url, followable(hrefs))}, link -> link is null))")


def links_on(links: str, seed_netloc: str) -> Column:
    """Links to the seed's host; a seed without host has none.

    The path of a canonical web link begins with a slash, so its start tells its host; of
    other schemes the host is cut out. What a link must start with is worked out once a page.
    """
    host = f"coalesce({seed_netloc}, '')"
    starts = ", ".join(f"'{s}', concat('{s}://', {host}, '/')" for s in ("http", "https"))
    web = " ".join(f"when startswith(link, '{s}://') then startswith(link, g.{s})" for s in ("http", "https"))
    on_host = f"case {web} else {canonical_netloc('link')} = g.host end"
    return F.expr(f"transform(array(named_struct('links', {links}, 'host', {host}, {starts})), g -> filter(g.links, link -> {on_host}))[0]")


def links_off(links: str, internal: str) -> Column:
    """Links, each once, that are not among the internal ones: those to other hosts."""
    return F.array_except(links, internal)


def mailto_emails(hrefs: str) -> Column:
    """Addresses of mail links: text up to the first ``?``, trimmed, not checked."""
    links = F.expr(f"filter({hrefs}, h -> startswith(lower(h), '{MAILTO}'))")
    addresses = F.transform(links, lambda h: trim_unicode(F.split_part(F.substr(h, F.lit(len(MAILTO) + 1)), F.lit("?"), F.lit(1))))
    return F.filter(addresses, lambda address: address != "")


def page_emails(hrefs: str, text: str, linked: str | None = None) -> Column:
    """Distinct addresses of mail links and visible text, sorted. ``linked`` has those of the
    links where they are known."""
    known = [F.col(linked)] if linked else []
    mails = F.coalesce(*known, mailto_emails(hrefs), F.expr(NO_STRINGS))
    return F.sort_array(F.array_union(mails, emails_in(F.col(text))))


def page_images(srcs: str, base_url: str) -> Column:
    """Distinct canonical image URLs, sorted."""
    found = canonical_refs_sql(base_url, f"filter({srcs}, s -> s <> '')")
    return F.expr(f"coalesce(sort_array(array_distinct(array_compact({found}))), {NO_STRINGS})")


def page_description(metas: Column, first_p: Column) -> Column:
    """First description tag, or the first paragraph where that is blank."""
    described = F.filter(metas, lambda m: m["name"] == "description")
    return F.coalesce(_first_content(described), blank_to_null(first_p))


def meta_property(metas: Column, prop: str) -> Column:
    """Trimmed content of the first tag with this property; blank gives NULL."""
    return _first_content(F.filter(metas, lambda m: m["property"] == prop))


def _first_content(metas: Column) -> Column:
    return blank_to_null(trim_unicode(F.try_element_at(metas, F.lit(1))["content"]))


#: Facts of a page, and the elements each is made from.
_ELEMENTS_OF = {"title": ("title_raw",), "links": ("hrefs",), "emails": ("hrefs", "at_text"), "images": ("srcs",)}
FACTS = tuple(_ELEMENTS_OF)


def page_facts(
    pages: DataFrame, keep: Sequence[str], base_url: str = "final_url", fields: Sequence[str] = FACTS, counts: Counts | None = None
) -> DataFrame:
    """``keep`` columns with title, canonical links, emails and images of each page, or
    those named: the facts of a page that do not depend on who visits it.

    Only the elements they need are read, and plain references resolved on the way; the
    others are left to ``page_links`` and ``page_images``. ``counts`` gets ``pages_read``, ``pages_refused`` by
    the tokenizer and, with links, ``refs_left_out`` for want of a valid host.
    """
    carried = list(dict.fromkeys([*keep, base_url]))
    wanted = list(dict.fromkeys(e for f in fields for e in _ELEMENTS_OF[f]))
    elements = extract_elements(pages, wanted, carried, base_url)
    if counts is not None:
        counted = {"pages_read": F.count(F.lit(1)), "pages_refused": how_many(F.col("parse_error").isNotNull())}
        if "links" in fields:
            counted["refs_left_out"] = F.coalesce(F.sum(rejected_refs("hrefs", base_url)), F.lit(0))
        elements = watched(elements, counts, **counted)
    made = {
        "title": lambda: page_title(F.col("title_raw")),
        "links": lambda: F.coalesce(F.col("plain_links"), page_links("hrefs", base_url)),
        "emails": lambda: page_emails("hrefs", "at_text", "linked_mails"),
        "images": lambda: F.coalesce(F.col("plain_images"), page_images("srcs", base_url)),
    }
    return elements.select(*keep, *[made[f]().alias(f) for f in FACTS if f in fields])


def with_split_links(facts: DataFrame, seed_netloc: str) -> DataFrame:
    """Replace ``links`` by internal and external links as seen from a seed's host."""
    split = facts.withColumn("internal_links", links_on("links", seed_netloc))
    return split.withColumn("external_links", links_off("links", "internal_links")).drop("links")


def profile_pages(responses: DataFrame, seed_netloc: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per page with its title, links split by the seed's host, emails and
    images. Pages without body give NULL title and empty arrays."""
    carried = list(dict.fromkeys([*keep, "final_url", seed_netloc]))
    facts = page_facts(responses, carried).withColumn("split_by", F.lower(seed_netloc))
    return with_split_links(facts, "split_by").select(
        *keep,
        F.col("final_url").alias("url"),
        "title",
        "internal_links",
        "external_links",
        "emails",
        "images",
    )


def page_problems(responses: DataFrame, keep: Sequence[str], base_url: str = "final_url") -> DataFrame:
    """Pages the tokenizer refused, or with references left out: ``keep`` columns,
    ``parse_error`` and ``n_rejected_refs``."""
    carried = list(dict.fromkeys([*keep, base_url]))
    elements = extract_elements(responses, ("hrefs",), carried)
    counted = elements.select(
        *keep, "parse_error", F.coalesce(rejected_refs("hrefs", base_url), F.lit(0)).alias("n_rejected_refs")
    )
    return counted.filter(F.col("parse_error").isNotNull() | (F.col("n_rejected_refs") > 0))


def page_descriptions(responses: DataFrame, keep: Sequence[str]) -> DataFrame:
    elements = extract_elements(responses, ("metas", "first_p"), keep)
    return elements.select(*keep, page_description(F.col("metas"), F.col("first_p")).alias("description"))


def fetched_posts(responses: DataFrame) -> DataFrame:
    """Posts whose fetch gave a body, an empty one included."""
    return responses.filter((F.col("status") != 0) & F.col("html").isNotNull())


def post_metadata(responses: DataFrame) -> DataFrame:
    """One row per fetched social post: title, description, image and poster."""
    elements = extract_elements(fetched_posts(responses), ("title_raw", "metas"), ("final_url", "status"))
    described = elements.select(
        F.lit(POST_KIND).alias("kind"),
        F.col("final_url").alias("url"),
        "status",
        F.coalesce(page_title(F.col("title_raw")), F.lit(POST_TITLE)).alias("title"),
        meta_property(F.col("metas"), "og:description").alias("description"),
        meta_property(F.col("metas"), "og:image").alias("image_url"),
        meta_property(F.col("metas"), "og:title").alias("og_title"),
    )
    username = post_username(F.col("description"), F.col("og_title"))
    return described.withColumn("username", username).drop("og_title")
