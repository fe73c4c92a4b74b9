"""Toxicity by a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text's features are the n-grams of its distinct words (2 to 5 characters, the ends
of a word marked), hashed into BUCKETS. Their log-count ratios between the labels come
from all labelled rows, summed on the executors; the logistic weights on the scaled
features are fitted on a bounded sample of them, FIT_ROWS a label. What the driver and
the tasks get is a few numbers a bucket, and the features of that sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.llm.common import Scorer, append_columns, documents, fold, keep_rows, least_rows, named, sliced, texts
from pagegraph.operators.keys import MAYBE, maybe_among
from pagegraph.session import staged

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
SIZES = (2, 3, 4, 5)

#: Rows of each label that weights are fitted on, at most: the least by a hash of the id.
FIT_ROWS = 1500
#: Buckets whose counts travel as one row.
PART = 4096
#: Steps of the fit, their length, and the pull of the weights to zero.
ROUNDS = 100
RATE = 2.0
RIDGE = 1e-7

WORDS = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and the place of the word each belongs to."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marks = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners = [], []
    for size in SIZES:
        if len(marks) < size:
            continue
        hashed = np.full(len(marks) - size + 1, size, np.uint64)
        for k in range(size):
            hashed = (hashed ^ marks[k : len(marks) - size + 1 + k]) * _MIX
            hashed ^= hashed >> np.uint64(29)
        inside = owner[: len(owner) - size + 1] == owner[size - 1 :]
        buckets.append((hashed[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[: len(owner) - size + 1][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def distinct_words(text: str) -> list[str]:
    return list(dict.fromkeys(WORDS.findall(text.lower())))


@dataclass
class Model:
    """A weight a bucket and what stands without any; ``constant`` in place of both if set."""

    weights: np.ndarray
    intercept: float
    constant: float | None = None


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows, by label: how many have each bucket, PART buckets to a row of
    4-byte numbers, and how many rows there are (part -1)."""
    sums, rows = np.zeros((2, BUCKETS), np.int32), np.zeros((2, 1), np.int32)
    for batch in batches:
        for part in sliced(batch, 1):
            for label, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
                sums[label, np.unique(word_features(distinct_words(text))[0])] += 1
                rows[label] += 1
    for label in (0, 1):
        if rows[label]:
            parts = [rows[label], *sums[label].reshape(-1, PART)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(parts), pa.int32()), pa.array(range(-1, len(parts) - 1), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["label", "part", "counts"],
            )


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one part of the buckets, added up: 8-byte numbers."""
    total = 0
    for batch in batches:
        for counts in batch.column(2).to_pylist():
            total = total + np.frombuffer(counts, np.int32).astype(np.int64)
    yield pa.RecordBatch.from_pydict({"label": [key[0]], "part": [key[1]], "counts": [total.tobytes()]})


def bucket_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of rows ``label, text``: how many of each label have each bucket, and how many there are."""
    shape = "label int, part int, counts binary"
    told = labelled.select("label", "text").mapInArrow(_sums, shape).groupBy("label", "part").applyInArrow(_added, shape).collect()
    sums, rows = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    for label, part, counts in told:
        numbers = np.frombuffer(counts, np.int64)
        if part < 0:
            rows[label] = numbers[0]
        else:
            sums[label, part * PART : (part + 1) * PART] = numbers
    return sums, rows


def log_ratios(sums: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How much likelier, as a logarithm, a row of label 1 has each bucket than one of label 0; one more row of each assumed."""
    return np.log((sums[1] + 1.0) / (rows[1] + 2)) - np.log((sums[0] + 1.0) / (rows[0] + 2))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, 1):
            found = [np.unique(word_features(distinct_words(t))[0], return_counts=True) for t in texts(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int32()), pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())), pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))],
                names=["label", "buckets", "counts"],
            )


#: Features worked on at a time.
CHUNK = 1 << 20


def fit(features: list[tuple[int, np.ndarray, np.ndarray]], ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights on the scaled features of some rows, and the intercept; both labels weigh alike."""
    labels = np.array([label for label, _, _ in features], np.float64)
    lengths = np.array([len(b) for _, b, _ in features])
    column = np.concatenate([b for _, b, _ in features])
    values = np.concatenate([(n / np.sqrt(n.sum())).astype(np.float32) * ratios[b].astype(np.float32) for _, b, n in features])
    used = np.zeros(BUCKETS, bool)
    used[column] = True
    own = np.flatnonzero(used)
    place = np.zeros(BUCKETS, np.int32)
    place[own] = np.arange(len(own))
    column = place[column]
    # Whole rows to a chunk, so that no step holds more than a chunk's features in doubles. A
    # chunk is kept by rows and by columns: sums over either are sums of runs.
    ends = np.cumsum(lengths)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(CHUNK, ends[-1] + CHUNK, CHUNK), side="right"), [len(lengths)]]))
    chunks = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = ends[a] - lengths[a], ends[b - 1]
        order = np.argsort(column[low:high], kind="stable")
        row = np.repeat(np.arange(a, b, dtype=np.int32), lengths[a:b])[order]
        columns, firsts = np.unique(column[low:high][order], return_index=True)
        chunks.append((slice(a, b), slice(low, high), ends[a:b] - lengths[a:b] - low, values[low:high][order], row, columns, firsts))
    weights, intercept = np.ones(len(own)) * 0.1, 0.0
    # Steps are scaled by each feature's own gradients.
    balance = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    seen, seen_i = np.full(len(own), 1e-12), 1e-12
    error = np.zeros(len(labels))
    for _ in range(ROUNDS):
        step = RIDGE * weights
        for rows, at, starts, by_column, row, columns, firsts in chunks:
            margin = np.add.reduceat(values[at] * weights[column[at]], starts) + intercept
            error[rows] = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) * balance[rows]
            step[columns] += np.add.reduceat(by_column * error[row], firsts)
        seen += step**2
        weights -= RATE * step / np.sqrt(seen)
        step_i = error.sum()
        seen_i += step_i**2
        intercept -= RATE * step_i / np.sqrt(seen_i)
    whole = np.zeros(BUCKETS)
    whole[own] = weights * ratios[own]
    return whole, intercept


def marks(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """``id`` and ``label`` of every id marked 0 or 1; marked both ways it counts as 1."""
    known = labels.filter(named(label_col).isin(0, 1) & named(id_col).isNotNull())
    return known.groupBy(named(id_col).alias("id")).agg(F.max(named(label_col)).cast("int").alias("label"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from documents with a text that ``labels`` marks 0 or 1; others teach nothing.

    Each such row counts for the ratios, repeated ids and texts included. The weights are
    fitted on at most ``fit_rows`` rows a label, the least by a hash of id and text. With rows of
    one label only, the score is that label's smoothed share; with none it is 0.
    """
    texts_of = docs.filter(named(text_col).isNotNull()).select(
        named(id_col).alias("id"), named(text_col).alias("text"), F.xxhash64(named(id_col), named(text_col)).alias("h")
    )
    known = staged(marks(labels, label_col, id_col), "toxic-marks")
    n = known.count()
    if not n:
        return Model(np.zeros(1), 0.0, 0.0)
    # Texts of other ids stay where they are: a filter over the marked ids holds them back. The
    # rest meet their labels by a shuffle, at any size.
    marked = maybe_among(texts_of, known, ["id"], n).filter(F.col(MAYBE)).drop(MAYBE)
    labelled = marked.join(known.hint("merge"), "id")
    sums, rows = bucket_counts(labelled)
    if not rows.all():
        total = rows.sum()
        return Model(np.zeros(1), 0.0, float((rows[1] + 0.5) / (total + 1)) if total else 0.0)
    ratios = log_ratios(sums, rows)
    least = least_rows(labelled.select("label", "h"), "label", ["h"], fit_rows).groupBy("label").agg(F.max("h").alias("upto"))
    upto = dict(least.collect())
    # Texts beyond the greatest limit go before they are joined.
    few = texts_of.filter(F.col("h") <= max(upto.values())).join(known.hint("merge"), "id")
    chosen = few.filter(F.col("h") <= F.when(F.col("label") == 1, upto[1]).otherwise(upto[0]))
    sample = staged(chosen.dropDuplicates(["label", "h"]).select("label", "text"), "fit-sample")
    told = sample.mapInArrow(_features, "label int, buckets array<int>, counts array<int>").toArrow()
    features = [(label, np.asarray(b.values), np.asarray(n.values)) for label, b, n in zip(told["label"].to_pylist(), told["buckets"], told["counts"])]
    features = sorted((f for f in features if len(f[1])), key=lambda f: (f[0], f[1].tobytes(), f[2].tobytes()))
    if not features:
        return Model(np.zeros(1), 0.0, float((rows[1] + 0.5) / (rows.sum() + 1)))
    weights, intercept = fit(features, ratios)
    return Model(weights.astype(np.float32), float(intercept))


class Judge:
    """The model at work in a task; remembers the sums of words it has met."""

    KEPT = 300_000

    def __init__(self, model: Model):
        self.model = model
        self.met: dict[str, tuple[float, int]] = {}

    def scores(self, batch: list[str]) -> list[float]:
        if self.model.constant is not None:
            return [self.model.constant] * len(batch)
        lists = [distinct_words(t) for t in batch]
        if len(self.met) > self.KEPT:
            self.met = {}
        new = list({w: None for words in lists for w in words if w not in self.met})
        buckets, owner = word_features(new)
        sums = np.bincount(owner, self.model.weights[buckets], len(new))
        self.met.update(zip(new, zip(sums.tolist(), np.bincount(owner, minlength=len(new)).tolist())))
        scores = []
        for words in lists:
            met = [self.met[w] for w in words]
            margin = sum(s for s, _ in met) / max(sum(n for _, n in met), 1) ** 0.5 + self.model.intercept
            scores.append(float(1 / (1 + np.exp(-np.clip(margin, -30, 30)))))
        return scores


def classify(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``rows`` without the text, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    A null text counts as empty and gets the score that stands without any feature.
    Other columns stay but those named like a new one; repeated rows count each, an empty
    table gives an empty one, and of a long text all distinct words count.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scorer() -> Scorer:
        judge = Judge(shared.value)

        def score(column: pa.Array) -> list[list]:
            scores = judge.scores(texts(column))
            return [scores, [int(s >= 0.5) for s in scores]]

        return score

    return append_columns(rows, text_col, T.StructType().add("score", "double").add("predicted", "integer"), scorer)


def keep_clean(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, whole, that score under 0.5."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judge():
        own = Judge(shared.value)
        return lambda column: [s < 0.5 for s in own.scores(texts(column))]

    return keep_rows(rows, text_col, judge)


HELD_OUT = 0
FOLDS = 5


def train_on(docs: DataFrame, sf_dir: str) -> Model:
    """Learn from the labelled documents outside the held-out fold."""
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet")
    return train(docs, labels.filter(fold("doc_id", FOLDS) != HELD_OUT))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    model = train_on(docs, sf_dir)
    return classify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
