import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagegraph.llm import mixing
from tests.llm.conftest import values


def by_hand(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets as the rule says it: share by weight, stop at the bound, share the excess anew."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, list(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in full]
    return target


def sized(df):
    return df.withColumn("size", mixing.word_count(F.col("text")))


def test_targets_taken_and_reruns(odd, odd_rows):
    mixed = mixing.mix(sized(odd), "size", tie=F.xxhash64("text"))
    rows = mixed.collect()
    assert len(rows) == len(odd_rows)
    sizes = {}
    for _, text, _, source, _ in odd_rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = by_hand(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: round(t) for s, t in targets.items()}
    columns = ("doc_id", "size", "taken")
    again = mixing.mix(sized(odd).repartition(3), "size", tie=F.xxhash64("text"))
    assert values(again, *columns) == values(mixed, *columns)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 50), min_size=1))
def test_water_level(spark, sizes):
    rows = [("n" if s is None else "s" + s, n) for s, n in sizes.items()]
    got = mixing.source_targets(spark.createDataFrame(rows, "source_key string, source_size long")).collect()
    want = by_hand(sizes)
    assert {r.source_key: pytest.approx(r.target) for r in got} == {"n" if s is None else "s" + s: t for s, t in want.items()}


def test_copies_hold_the_words_taken(odd):
    mixed = mixing.mix(sized(odd), "size", tie=F.xxhash64("text"))
    out = mixing.repeated(mixed, "text", "size", odd.columns, "n_chars")
    assert out.columns == odd.columns
    got = out.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert got == mixed.select(F.sum("taken")).first()[0]
    assert not out.filter("n_chars > 0 AND doc_id <> 10 AND doc_id < 9 AND doc_id <> 1 AND n_chars <> length(text)").count()


def test_empty_and_clashing(none, clashing, odd):
    assert mixing.mix(sized(none), "size").count() == 0
    mixed = mixing.mix(sized(clashing), "size", tie=F.xxhash64("text"))
    plain = mixing.mix(sized(odd), "size", tie=F.xxhash64("text"))
    assert values(mixed, "doc_id", "taken") == values(plain, "doc_id", "taken")
    assert set(clashing.columns) <= set(mixed.columns)


def test_a_third_of_all_rows_on_one_id(spark):
    """Null ids, equal in all columns too, at the cut: taken words follow the order, whatever the runs they are dealt in."""
    rows = [(i, "a", 3 + i % 4) for i in range(300)] + [(None, "a", 5)] * 150 + [(None, "a", 1 + i % 3) for i in range(60)] + [(7, None, 2)] * 40
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    targets = by_hand({"a": sum(n for _, s, n in rows if s), None: 80})

    def key(row):
        return hashlib.md5(f"mix:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[0] or -1, row[2]

    want = Counter()
    for source in ("a", None):
        own = sorted((r for r in rows if r[1] == source), key=key)
        total, left = sum(r[2] for r in own), round(targets[source])
        rounds, left = divmod(left, total)
        for r in own:
            part = max(0, min(r[2], left))
            left -= part
            want[(r[0], r[2], rounds * r[2] + part)] += 1
    for parts in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = Counter((r.doc_id, r["size"], r.taken) for r in mixing.mix(df.repartition(4), "size").collect())
        finally:
            spark.conf.unset("spark.sql.shuffle.partitions")
        assert got == want
