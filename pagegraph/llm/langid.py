"""Language identification by words first, character n-grams for the rest.

A known word adds its log frequency in each language. An unseen one backs off to its
longest character n-grams that are known, from NGRAM letters down to one.

The frequencies come from a bounded sample of labelled rows, counted on the
executors; the model's size is bounded by that sample and it is sent to the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pagegraph.llm.common import Scorer, append_columns, documents, fold, keep_rows, least_rows, named, texts
from pagegraph.session import staged

#: Labelled rows of a language that are learned from, at most; the least by a hash of id and text.
ROWS = 1000
#: Words and n-grams seen less often are left out.
LEAST_WORDS = 2
LEAST_GRAMS = 2
NGRAM = 5
#: Words of evidence beyond which the score gets no surer.
ENOUGH = 20
UNDETERMINED = "und"

#: Words are runs of letters; signs of numbers such as ² or Ⅷ are none.
LETTERS = regex.compile(r"\p{L}+")


def bounded_sample(rows: DataFrame, group: Column, id_col: str, text_col: str, most: int) -> DataFrame:
    """Columns ``label`` and ``text``: at most ``most`` rows of each group, the least by hash.

    Ranks cut the groups on the map side; the texts of other rows are never moved.
    """
    hashed = rows.select(group.alias("label"), F.xxhash64(named(id_col), named(text_col)).alias("h"), named(text_col).alias("text"))
    hashed = hashed.filter(F.col("label").isNotNull() & F.col("text").isNotNull())
    ranks = least_rows(hashed.select("label", "h"), "label", ["h"], most)
    limits = staged(ranks.groupBy("label").agg(F.max("h").alias("limit")), "sample-limits")
    met = hashed.join(limits, "label").filter(F.col("h") <= F.col("limit"))
    return met.dropDuplicates(["label", "h"]).select("label", "text")


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked; of length one: its letters."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, counts: list[tuple[str, str, str, int]]):
        """``counts``: kind ('w' or the n-gram's length), key, language, number."""
        self.languages = sorted({language for _, _, language, _ in counts})
        at = {language: i for i, language in enumerate(self.languages)}
        #: By kind, the row of each key in ``logs``.
        places: dict[str, dict[str, int]] = {}
        spots = []
        for kind, key, language, n in counts:
            table = places.setdefault(kind, {})
            spots.append((kind, table.setdefault(key, len(table)), at[language], n))
        logs = {}
        for kind, table in places.items():
            own = np.zeros((len(table), len(at)))
            for _, row, column, n in (s for s in spots if s[0] == kind):
                own[row, column] += n
            logs[kind] = np.log((own + 0.5) / (own.sum(axis=0) + 0.5 * (len(table) + 1))).astype(np.float32)
        self.words, self.word_logs = places.pop("w", {}), logs.pop("w", np.zeros((0, len(at)), np.float32))
        self.grams = {int(kind): (table, logs[kind]) for kind, table in places.items()}

    def unseen(self, word: str) -> np.ndarray:
        """Back off: the mean of the longest n-grams of the word that are known."""
        for n in range(NGRAM, 0, -1):
            table, logs = self.grams.get(n, ({}, None))
            if found := [table[g] for g in grams(word, n) if g in table]:
                return logs[found].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)


class Predictor:
    """The model at work in a task; remembers words it has met."""

    KEPT = 200_000

    def __init__(self, model: Model):
        self.model = model
        self.met: dict[str, np.ndarray] = {}

    def logs(self, counts: Counter) -> np.ndarray:
        """The log frequencies of a text's words, summed by language."""
        known = {w: n for w, n in counts.items() if w in self.model.words}
        rows = [self.model.words[w] for w in known]
        total = np.array(list(known.values()), np.float64) @ self.model.word_logs[rows] if known else 0.0
        if len(self.met) > self.KEPT:
            self.met = {}
        for word in (w for w in counts if w not in known):
            vector = self.met.get(word)
            if vector is None:
                vector = self.met[word] = self.model.unseen(word)
            total = total + counts[word] * vector
        return total

    def predict(self, text: str) -> tuple[str, float]:
        counts = Counter(LETTERS.findall(text.lower()))
        if not counts or not self.model.languages:
            return UNDETERMINED, 0.0
        n = counts.total()
        logs = self.logs(counts) * (min(n, ENOUGH) / n)
        best = int(np.argmax(logs))
        return self.model.languages[best], float(1.0 / np.exp(logs - logs[best]).sum())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in Counter(LETTERS.findall(text.lower())).items():
                counts["w", word, label] += n
                for size in range(1, NGRAM + 1):
                    for gram in grams(word, size):
                        counts[str(size), gram, label] += n
    keys = list(zip(*counts)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([*(pa.array(k, pa.string()) for k in keys), pa.array(counts.values(), pa.int64())], names=["kind", "key", "label", "n"])


def train(rows: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", most: int = ROWS) -> Model:
    """Learn from at most ``most`` rows of each language; rows without language or text teach nothing."""
    sample = bounded_sample(rows, named(lang_col), id_col, text_col, most)
    counts = sample.mapInArrow(_counted, "kind string, key string, label string, n long").groupBy("kind", "key", "label").agg(F.sum("n").alias("n"))
    whole = counts.withColumn("all", F.sum("n").over(Window.partitionBy("kind", "key")))
    known = whole.filter(F.col("all") >= F.when(F.col("kind") == "w", LEAST_WORDS).otherwise(LEAST_GRAMS)).drop("all")
    table = known.toArrow().sort_by([("kind", "ascending"), ("key", "ascending"), ("label", "ascending")])
    return Model(list(zip(*(column.to_pylist() for column in table.columns))))


def identify(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``rows`` without the text, with ``lang_pred`` and ``score`` (0 to 1).

    ``und`` and 0 for a null text, one without letters, or a model that has learned
    nothing. Equal logs go to the first language by name. Other columns stay but those
    named like a new one. Repeated rows count each, an empty table gives an empty one,
    and of a long text all words count.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scorer() -> Scorer:
        predictor = Predictor(shared.value)

        def score(column: pa.Array) -> list[list]:
            told = [predictor.predict(t) for t in texts(column)]
            return [[lang for lang, _ in told], [s for _, s in told]]

        return score

    return append_columns(rows, text_col, T.StructType().add("lang_pred", "string").add("score", "double"), scorer)


def keep_known(rows: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows, whole, whose language is told with a score of ``least`` or more."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judge():
        predictor = Predictor(shared.value)

        def accepts(column: pa.Array) -> list[bool]:
            told = [predictor.predict(t) for t in texts(column)]
            return [lang != UNDETERMINED and score >= least for lang, score in told]

        return accepts

    return keep_rows(rows, text_col, judge)


HELD_OUT = 2
FOLDS = 4


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    model = train(docs.filter(~held_out))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)


