"""Registered queries against their SQL, the contract's columns, and the pipeline."""

import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pagegraph.llm import bpe, langid, neardup, toxicity
from pagegraph.llm.common import fold
from pagegraph.llm.queries import ORACLES, QUERIES
from pagegraph.session import staged
from tests.llm.test_mixing import by_hand as targets_by_hand
from tests.oracle_check import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_": "doc_id size source_size target taken",
    "op2_": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op6_": "doc_id held_out lang_pred score",
    "op7_": "doc_id held_out score predicted",
    "op8_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10_": "doc_id fingerprint component_id",
    "op11_": "vec_id component n deviation whitened explained identity_error",
    "op12_": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13_": "page_id url text n_chars",
}

#: Tables other than documents, and rows of the result to a row of the table.
TABLES = {"op11_": ("embeddings", 4), "op12_": ("embeddings", 1), "op13_": ("pages", 1)}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())
    assert all(sum(name.startswith(p) for name in QUERIES) == 1 for p in COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    prefix = name[: name.index("_") + 1]
    assert set(COLUMNS[prefix].split()) <= set(df.columns)
    rows = [tuple(r) for r in df.collect()]
    table, times = TABLES.get(prefix, ("documents", 1))
    assert len(rows) == times * spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if name in ORACLES:
        result = connect(SF_DIR).execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, rows) == rows_of(columns, result.fetchall())


def near_copies_by_hand(rows):
    """The rows that stay, over all pairs of fingerprints."""
    prints = [neardup.simhash(neardup.shingle_hashes((r.text or "").encode(), 3)) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    stays = {}
    for i, r in enumerate(rows):
        key = (r.doc_id is None, r.doc_id or 0)
        stays[root(i)] = min(stays.get(root(i), key), key)
    return sorted(stays.values())


def test_pipeline_stages(spark):
    """Every stage against a brute-force version of its rows, on what the one before has kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    ids = lambda rows: sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language", "near_duplicates", "mixing", "bpe"]

    def step(name, rows):
        out = staged(stages[name](spark, rows, SF_DIR), name)
        assert name == "bpe" or out.columns == columns
        return out, rows.collect(), out.collect()

    judge = toxicity.Judge(toxicity.train_on(docs, SF_DIR))
    docs, before, after = step("toxicity", docs)
    assert ids(after) == ids(r for r in before if judge.scores([r.text or ""])[0] < 0.5)
    assert 0.5 * len(before) < len(after) < len(before)

    model = langid.train(docs.filter(fold("doc_id", 4) != 2))
    predictor = langid.Predictor(model)
    docs, before, after = step("language", docs)
    told = [(r, *predictor.predict(r.text or "")) for r in before]
    assert ids(after) == ids(r for r, lang, score in told if lang != "und" and score >= 0.5)

    docs, before, after = step("near_duplicates", docs)
    assert ids(after) == near_copies_by_hand(before) and len(after) < len(before)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    docs, before, after = step("mixing", docs)
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
    sizes = {s: sum(len(words(r.text)) for r in before if r.source == s) for s in {r.source for r in before}}
    taken = {s: sum(len(words(r.text)) for r in after if r.source == s) for s in sizes}
    assert taken == {s: round(t) for s, t in targets_by_hand(sizes).items()}
    whole = {(r.doc_id, r.text) for r in before}
    cut = [r for r in after if (r.doc_id, r.text) not in whole]
    assert len(cut) <= len(sizes) and all(r.n_chars == len(r.text) for r in cut)
    texts = {r.doc_id: words(r.text) for r in before}
    assert all(texts[r.doc_id][: len(words(r.text))] == words(r.text) for r in cut)
    # Whole rounds first: of a source no row is there twice more often than another.
    times = Counter((r.source, r.doc_id) for r in after)
    for s in sizes:
        own = [times[s, r.doc_id] for r in before if r.source == s and words(r.text)]
        assert max(own) - min(own) <= 1

    docs, before, after = step("bpe", docs)
    encoder = library()
    want = Counter((r.doc_id, tuple(encoder.encode(r.text or "", add_special_tokens=False).ids)) for r in before)
    assert Counter((r.doc_id, tuple(r.ids)) for r in after) == want
    assert all(r.n_tokens == len(r.ids) for r in after) and "text" not in docs.columns

    rerun = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert rerun == want


def library():
    tokenizer = Tokenizer.from_file(bpe.default_vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_pipeline_on_odd_rows(spark, odd, clashing, none):
    for rows in (clashing, none):
        docs = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF_DIR), name)
            assert docs.columns == rows.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()
