import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagegraph.llm import neardup
from pagegraph.llm.components import components
from tests.llm.conftest import values


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def close_values(n, seed):
    """Values in loose clouds, so that many lie within two bits of each other."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (n, 3), dtype=np.uint64), axis=1)
    return np.unique(centres[rng.integers(0, 8, n)] ^ flips)


def test_tree_finds_all_within_the_radius():
    v = close_values(400, 1)
    tree = neardup.BKTree(v)
    for radius in (0, 2, 9):
        found = {(int(q), int(n)) for qs, ns in tree.within(v, radius) for q, n in zip(qs, ns)}
        assert found == {(i, j) for i in range(len(v)) for j in range(len(v)) if bin(int(v[i] ^ v[j])).count("1") <= radius}


@pytest.mark.parametrize("rows", [4096, 20])
def test_shards_lose_no_link(spark, monkeypatch, rows):
    """Also where every block value is crowded and cut further."""
    monkeypatch.setattr(neardup, "SHARD_ROWS", rows)
    v = close_values(300, 2)
    stars = components(neardup.shard_links(spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long"), 2))
    got = {r.u: r.v for r in stars.collect()}
    pairs = [(i, j) for i in range(len(v)) for j in range(i) if bin(int(v[i] ^ v[j])).count("1") <= 2]
    want = roots(len(v), pairs)
    labels = [got.get(int(x), int(x)) for x in v.view(np.int64)]
    assert len(set(zip(labels, want))) == len(set(labels)) == len(set(want))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (201, 200)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 20)} | {201: 200}


def fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_texts_against_brute_force(odd, odd_rows, none, clashing):
    prints = [fingerprint(r[1]) for r in odd_rows]
    group = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    least = {g: min((r[0] for r, k in zip(odd_rows, group) if k == g and r[0] is not None), default=None) for g in group}
    want = sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(odd_rows, prints, group)), key=repr)
    columns = ("doc_id", "fingerprint", "component_id")
    assert values(neardup.linked(odd), *columns) == want
    assert neardup.linked(none).count() == 0
    assert values(neardup.linked(clashing), *columns) == want


def kept_by_hand(rows):
    """Ids and texts that stay, over all pairs of fingerprints; null ids last."""
    prints = [fingerprint(t) for _, t in rows]
    group = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    stays = {}
    for (i, _), g in zip(rows, group):
        stays.setdefault(g, []).append((i is None, i or 0))
    return sorted(min(own) for own in stays.values())


@pytest.mark.parametrize("shard", [4096, 8])
def test_one_of_each_group_stays(spark, monkeypatch, shard):
    """Exact copies (a third of all rows one text), near copies, chains, texts without words; crowded shards too."""
    monkeypatch.setattr(neardup, "SHARD_ROWS", shard)
    rng = random.Random(5)
    texts = []
    for d in range(40):
        words = [f"d{d}w{i}" for i in range(120)]
        texts.append(" ".join(words))
        for _ in range(d % 4):
            words = list(words)
            words[rng.randrange(120)] = f"new{rng.randrange(10**9)}"
            texts.append(" ".join(words))
    texts += [texts[0]] * 60 + ["", None, " \t"]
    rng.shuffle(texts)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = neardup.keep_one(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == kept_by_hand(rows)
    assert all((r.doc_id, r.text) in rows for r in kept)


def test_keep_one_on_odd_rows(odd, odd_rows, none, clashing):
    kept = neardup.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted((i is None, i or 0) for i, in values(kept, "doc_id")) == kept_by_hand([r[:2] for r in odd_rows])
    assert neardup.keep_one(none).count() == 0
    assert values(neardup.keep_one(odd), "doc_id") == values(kept, "doc_id")
    assert kept.select(F.countDistinct("size")).first()[0] == 1


def test_the_same_row_stays_in_every_run(spark):
    """Of rows equal in id and text but not in other columns, and of rows equal in all."""
    rows = [(1, "a b c d e", f"s{i % 5}") for i in range(20)] + [(2, "quite another text here", "t")] * 3
    schema = "doc_id long, text string, source string"
    kept = {tuple(values(neardup.keep_one(spark.createDataFrame(order, schema).repartition(n)), *schema.replace(" long", "").replace(" string", "").split(", "))) for order in (rows, rows[::-1]) for n in (1, 5)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2
