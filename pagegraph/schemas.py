"""Schemas shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

META = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("property", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

# Fields read from a page, by name; a job asks only for those it needs.
ELEMENTS = {
    "title_raw": T.StringType(),  # sole string of the first title
    "hrefs": STRINGS,  # a[href], document order
    "srcs": STRINGS,  # img[src], document order
    "metas": T.ArrayType(META),  # every meta tag, document order
    "text": T.StringType(),  # visible text, one blank between nodes
    "at_text": T.StringType(),  # the same for nodes that hold an "@"
    "first_p": T.StringType(),  # text of the first p, nodes run together
}

VISITS = T.StructType(
    [
        T.StructField("seed", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("internal_links", STRINGS),
        T.StructField("external_links", STRINGS),
        T.StructField("emails", STRINGS),
        T.StructField("images", STRINGS),
        T.StructField("level", T.IntegerType()),
        T.StructField("bfs_key", T.DecimalType(38, 0)),
    ]
)

SCRAPE_ROWS = T.StructType(
    [
        T.StructField("seed", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("source_url", T.StringType()),
    ]
)
