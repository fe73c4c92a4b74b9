"""Membership by filter, and one row of each key."""

import pytest
from pyspark.sql import functions as F

from pagegraph.operators import keys
from pagegraph.operators.counts import Counts, how_many
from pagegraph.operators.fetchlog import resolve_attempts
from pagegraph.session import staged
from pagegraph.sources.ndjson import read_ndjson
from pagegraph.sources.responses import ATTEMPT_COLUMNS, read_attempts


@pytest.mark.parametrize("blocks", [1 << 14, 1])
def test_split_is_exact(spark, monkeypatch, blocks):
    """Also where the filter is far too small: then more rows meet the list, and none is lost."""
    monkeypatch.setattr(keys, "MOST_BLOCKS", blocks)
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 1000 != 7, F.col("id") % 5000).alias("k"), F.lit("x").alias("block"))
    members = staged(spark.range(2500).select((F.col("id") * 2).alias("k")), "members")
    out, among = keys.split_by(rows, members, ["k"], 2500)
    assert out.columns == rows.columns == among.columns
    inside = F.coalesce(F.col("k") % 2 == 0, F.lit(False))
    assert sorted(r.id for r in among.collect()) == sorted(r.id for r in rows.filter(inside).collect())
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in rows.filter(~inside).collect())


@pytest.mark.parametrize("n", [3000, 60_000])
def test_few_others_hit_the_filter(spark, n):
    """The filter grows with its members: under one in twenty other keys hits it, at any number of them."""
    members = spark.range(n).select(F.col("id").alias("k"))
    others = spark.range(10**6, 10**6 + 40_000).select(F.col("id").alias("k"))
    assert keys.maybe_among(others, members, ["k"], n).filter(keys.MAYBE).count() < 0.05 * 40_000
    assert keys.maybe_among(members, members, ["k"], n).filter(f"NOT {keys.MAYBE}").count() == 0


def test_one_of_each(spark):
    rows = [(i % 50 if i % 4 else None, f"v{i % 7}", i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v string, c0 int")
    first = keys.one_of_each(df, ["k"], ("c0",))
    again = keys.one_of_each(spark.createDataFrame(rows[::-1], df.schema).repartition(7), ["k"], ("c0",))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    got = [r for r in first.collect() if r.k is not None]
    assert len(got) == len({k for k, _, _ in rows if k is not None})
    assert all(r.c0 == min(c for k, _, c in rows if k == r.k) for r in got)
    assert first.filter("k IS NULL").count() == sum(k is None for k, _, _ in rows)
    unique = spark.range(5)
    assert keys.one_of_each(unique, ["id"]) is unique


def test_attempts_delivered_twice(spark):
    """The same row of each attempt in every run; bodies of attempts that are there once are not moved."""
    schema = ", ".join(f"{n} {t}" for n, t in ATTEMPT_COLUMNS.items())
    rows = [(f"u{i}", 1, 200, f"u{i}", "text/html", f"b{i}", None) for i in range(40)]
    twice = rows + [(*r[:5], "other", None) for r in rows[:6]] + rows[3:9]
    kept = {frozenset(map(tuple, read_attempts(spark.createDataFrame(t, schema), distinct=True).collect())) for t in (twice, twice[::-1])}
    assert len(kept) == 1 and len(next(iter(kept))) == 40
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = read_attempts(spark.createDataFrame(twice, schema), distinct=True)
        plan = log._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    passing = plan[plan.index("Union") : plan.index("SortMergeJoin")]
    assert "hashpartitioning(url" not in passing


def test_counts(spark, tmp_path):
    counts = Counts()
    rows = counts.watch(spark.range(10), small=how_many(F.col("id") < 3), all=F.count(F.lit(1)))
    more = counts.watch(spark.range(4), small=how_many(F.col("id") < 1))
    assert rows.union(more).count() == 14
    assert counts.totals() == {"small": 4, "all": 10}
    (tmp_path / "a.ndjson").write_text('{"url": "u"}\n[1]\n\nnot json\n')
    counts = Counts()
    assert read_ndjson(spark, str(tmp_path / "a.ndjson"), "quarantine", counts=counts).count() == 1
    assert counts.totals() == {"lines_rejected": 2}


def test_counts_of_refused_urls(spark):
    schema = ", ".join(f"{n} {t}" for n, t in ATTEMPT_COLUMNS.items())
    log = [("u1", 1, None, None, None, None, "TooManyRedirects"), ("u2", 1, 200, "u2", "text/html", "b", None), ("u3", 1, None, None, None, None, "Timeout")]
    counts = Counts()
    assert len(resolve_attempts(spark.createDataFrame(log, schema), counts=counts).collect()) == 2
    assert counts.totals() == {"urls_refused": 1}


def test_counts_of_a_step_that_never_ran(spark, monkeypatch):
    monkeypatch.setattr(Counts, "PATIENCE", 0.1)
    counts = Counts()
    counts.watch(spark.range(3), n=F.count(F.lit(1)))
    assert counts.totals() == {"n": 0}
