"""Text helpers: Unicode trim, media types, e-mail addresses, handles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and prefixes results depend on.
EMAIL_PATTERN = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
HTML_MEDIA_TYPES = ("text/html", "application/xhtml+xml")
HANDLE_AFTER_DASH = r"(?U)-\s*([A-Za-z0-9_.]+)\s+on\b"
HANDLE_AT_START = r"(?U)^([A-Za-z0-9_.]+)\s+on\b"
HANDLE_IN_PARENS = r"\(@([A-Za-z0-9_.]+)\)"
HANDLE_ALONE = r"^([A-Za-z0-9_.]+)\z"

# An address begins where its run of name characters begins or where the last
# match ended. Anchoring there finds the same addresses, and a long run without
# "@" is read once and not once per start.
_EMAIL_SEARCH = r"(?:\G|(?<![A-Za-z0-9._%+\-]))" + EMAIL_PATTERN.replace("]+@", "]++@")

_WHITESPACE = r"[\s\x1c-\x1f]"


def trim_unicode(text: Column) -> Column:
    """Trim every kind of Unicode white space, not only blanks.

    A run of blanks inside is tried once, at its start, however long it is. A text with
    plain characters at both ends, which most have, is not searched at all.
    """
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    trimmed = F.regexp_replace(text, rf"(?U)^{_WHITESPACE}+|(?<!{_WHITESPACE}){_WHITESPACE}++\z", "")
    return F.when(first.between("!", "~") & last.between("!", "~"), text).otherwise(trimmed)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def is_html(content_type: Column) -> Column:
    """True when the media type, without parameters, names HTML or XHTML."""
    media_type = trim_unicode(F.split_part(F.lower(content_type), F.lit(";"), F.lit(1)))
    matches = [F.startswith(media_type, F.lit(known)) for known in HTML_MEDIA_TYPES]
    return F.coalesce(matches[0] | matches[1], F.lit(False))


def emails_in(text: Column) -> Column:
    """Every address in a text, in order, repeats included; NULL text gives none."""
    found = F.regexp_extract_all(text, F.lit(_EMAIL_SEARCH), F.lit(0))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))


def post_username(description: Column, og_title: Column) -> Column:
    """Poster's handle: two shapes of description, then two of the title."""
    return F.coalesce(
        blank_to_null(F.regexp_extract(description, HANDLE_AFTER_DASH, 1)),
        blank_to_null(F.regexp_extract(description, HANDLE_AT_START, 1)),
        blank_to_null(F.regexp_extract(og_title, HANDLE_IN_PARENS, 1)),
        blank_to_null(F.regexp_extract(og_title, HANDLE_ALONE, 1)),
    )
