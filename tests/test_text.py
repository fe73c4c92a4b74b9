"""Text columns: media types, addresses, handles, trimming."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagegraph.functions import text


def evaluated(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.got for r in df.select("i", build(F.col("v")).alias("got")).orderBy("i").collect()]


def test_is_html(spark):
    cases = {
        "text/html; charset=utf-8": True,
        " Text/HTML ; charset=utf-8 ": True,
        "APPLICATION/XHTML+XML": True,
        "text/html5": True,
        "application/json": False,
        " text/plain ": False,
        "": False,
        None: False,
    }
    assert evaluated(spark, cases, text.is_html) == list(cases.values())


def test_trim_knows_unicode_space(spark):
    values = ["  a b\t\n", "  x　", "\x1cy\x1f", "", "\n", "a", " ", "a ", "\x85b", "é ", "!  ~", "\x7f", "x" * 9 + " "]
    assert evaluated(spark, values, text.trim_unicode) == [v.strip() for v in values]


FRAGMENTS = st.sampled_from(["a", "b.c", "@", ".", "com", "x1", "-", " ", "_", "é", "%", "+", ".de", "@@", ".c", "1"])


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(FRAGMENTS, max_size=12).map("".join), min_size=400, max_size=400))
def test_addresses_are_those_of_the_plain_pattern(spark, values):
    got = evaluated(spark, values, text.emails_in)
    assert got == [re.findall(text.EMAIL_PATTERN, v) for v in values]


def test_addresses_next_to_each_other(spark):
    values = ["a@b.cde_f@x.com", "x" * 5000 + " a.b+c@d-e.org, A@B.CO", None, "a@b", "a@b.c1", "..@..aa"]
    got = evaluated(spark, values, text.emails_in)
    assert got == [re.findall(text.EMAIL_PATTERN, v or "") for v in values]


def test_username_cascade(spark):
    cases = [
        ("12 likes - handle_name on May 1", None, "handle_name"),
        ("iridescent_maine on May 1: x", None, "iridescent_maine"),
        ("Photo by someone", "Name (@paren_handle) post", "paren_handle"),
        (None, "simple_handle123", "simple_handle123"),
        (None, "two words", None),
        ("nothing here", None, None),
        ("a - first on x - second on y", "z", "first"),
        ("- wide on it", None, "wide"),
        ("- handle only", "fallback", "fallback"),
        ("x", "handle\n", None),
        (None, None, None),
    ]
    df = spark.createDataFrame(cases, "description string, og_title string, expected string")
    got = df.withColumn("got", text.post_username(F.col("description"), F.col("og_title"))).collect()
    assert [r.got for r in got] == [r.expected for r in got]


def test_trim_is_linear_in_a_run_of_blanks(spark):
    import time

    wide = "a" + " " * 1_000_000 + "b"
    start = time.perf_counter()
    assert evaluated(spark, [wide, " \u2003" + wide + "\x1c\n"], text.trim_unicode) == [wide, wide]
    assert time.perf_counter() - start < 5
