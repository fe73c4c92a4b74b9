"""Scoring by a Katz backoff bigram model.

  P(w | v) = d(c) c(v w) / c(v)     if the corpus has v w, c times
             a(v) P(w)              else, which is one step of recursion
  P(w)     = d(c) c(w) / N          if the corpus has w; what the discounts leave
             goes to one class of all unknown words

Discounts d are Good-Turing's for counts up to 5, none above. a(v) shares exactly what
the discounts of v's successors leave among the words not seen behind v, so every
context's probabilities sum to one.

How it is worked out: a task turns its documents into blocks of about BLOCK_TOKENS
tokens, numbered by the block's own dictionary. Whatever the corpus must know is asked
a block at a time: each distinct word or pair of a block goes once, as a 64-bit hash
with the block's own count, to the bucket of its hash; a bucket adds up and answers
every block that asked. So a word found everywhere costs one entry a block, and no key
is heavy. The answers, written by bucket, are the model's tables: word counts, pair
counts and the two sums behind a(v).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.llm.common import arrow_type, documents, fold, named, raw_texts, sliced
from pagegraph.session import Staging

#: Tokens of a block, about: what a task holds at once, besides one whole text.
BLOCK_TOKENS = 2_000_000
#: Entries that a bucket adds up at once, about.
BUCKET_TOKENS = 1_000_000
#: Counts up to this are discounted.
DISCOUNTED = 5

#: A block's dictionary starts with the end of a text and the start, which is only a context.
END, START = 0, 1
MARKS = [np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEF1B3A5D1)]
MIX = np.uint64(0x9E3779B97F4A7C15)

BLOCKS = T.StructType().add("block", "string").add("tokens", "binary").add("lengths", "binary").add("words", "binary").add("held_out", "binary")
ASKED = T.StructType().add("bucket", "integer").add("block", "string").add("keys", "binary").add("a", "binary").add("b", "binary")
TOLD = T.StructType().add("block", "string").add("bucket", "integer").add("kind", "string").add("a", "binary").add("b", "binary")


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, equal places of its items together."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 1)


def unpack(blob: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def rows_of(schema: T.StructType, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(c, arrow_type(f.dataType)) for c, f in zip(columns, schema)], names=schema.names)


# --- blocks -----------------------------------------------------------------------------------


class _Dictionary(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 2
        return number


def blocks_of(rows: DataFrame) -> DataFrame:
    """One row a block of ``id``, ``held_out``, ``text`` rows."""
    schema = T.StructType(BLOCKS.fields + [T.StructField("ids", T.ArrayType(rows.schema["id"].dataType))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        numbers, tokens, lengths, held_out, ids, size = _Dictionary(), [], [], [], [], 0

        def block() -> pa.RecordBatch:
            words = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
            values = (pack(np.concatenate(tokens)), pack(np.array(lengths, np.int64)), pack(np.append(MARKS, words)), pack(np.array(held_out, np.uint8)))
            return rows_of(schema, [(f"{task:08d}-{made:08d}", *values, ids)]).to_batches()[0]

        for batch in batches:
            for part in sliced(batch, 2):
                for i, held, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), raw_texts(part.column(2))):
                    words = raw.lower().split()
                    own = np.empty(len(words) + 1, np.int32)
                    own[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                    own[-1] = END
                    tokens.append(own)
                    lengths.append(len(own))
                    held_out.append(held)
                    ids.append(i)
                    size += len(own)
                    if size >= BLOCK_TOKENS:
                        yield block()
                        made += 1
                        numbers, tokens, lengths, held_out, ids, size = _Dictionary(), [], [], [], [], 0
        if ids:
            yield block()

    return rows.select("id", "held_out", "text").mapInArrow(run, schema)


class Block:
    """A block's tokens, its distinct words and its distinct pairs (context, word)."""

    def __init__(self, row: dict):
        self.name, self.ids = row["block"], row["ids"]
        self.tokens, self.lengths = unpack(row["tokens"], np.int32), unpack(row["lengths"], np.int64)
        self.held_out = unpack(row["held_out"], np.uint8).astype(bool)
        self.words = unpack(row["words"], np.uint64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        contexts = np.empty_like(self.tokens)
        contexts[1:] = self.tokens[:-1]
        contexts[self.starts] = START
        codes = contexts.astype(np.int64) << 32 | self.tokens
        codes, self.pair_of = np.unique(codes, return_inverse=True)
        self.context, self.word = codes >> 32, codes & 0xFFFFFFFF
        self.learns = np.repeat(~self.held_out, self.lengths)

    def pairs(self) -> np.ndarray:
        """The hashes of the pairs."""
        mixed = (self.words[self.context] * MIX) ^ (self.words[self.word] + (self.words[self.context] >> np.uint64(31)))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
        return mixed ^ (mixed >> np.uint64(32))

    def word_counts(self) -> np.ndarray:
        """Learned tokens of each word; START is none."""
        return np.bincount(self.tokens[self.learns], minlength=len(self.words))

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair_of[self.learns], minlength=len(self.context))

    def by_document(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts)


# --- asking buckets ---------------------------------------------------------------------------


def questions(block: str, hashes: np.ndarray, a: np.ndarray, b: np.ndarray | None, buckets: int) -> Iterator[tuple]:
    """Rows of ASKED: each bucket's hashes in order, as steps, with what the block has of them."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    bucket = ((ranked >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for k in np.flatnonzero(np.diff(edges)):
        at = slice(edges[k], edges[k + 1])
        steps = np.diff(ranked[at], prepend=np.uint64(0))
        yield int(k), block, pack(steps), pack(a[order[at]]), None if b is None else pack(b[order[at]])


def answered(asked: DataFrame, kind: str) -> DataFrame:
    """Sums over all blocks, for every block that asked, as TOLD.

    Counts ("words", "pairs") come back with a sign: plus to the first block that has
    learned the entry, which answers for it where entries are summed over, minus to the
    others. Sums of doubles ("sums") come back as they are.
    """
    of = np.float64 if kind == "sums" else np.int64

    def bucket(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        a = np.concatenate([unpack(x, of) for x in table.column("a").to_pylist()])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, a)[place]
        second = None
        if kind == "sums":
            b = np.concatenate([unpack(x, of) for x in table.column("b").to_pylist()])
            second = np.bincount(place, b)[place]
        else:
            has = np.flatnonzero(a > 0)
            first = has[np.unique(place[has], return_index=True)[1]]
            sign = np.full(len(a), -1)
            sign[first] = 1
            total = (total * sign).astype(np.int64)
        cuts = np.cumsum(sizes)[:-1]
        firsts = [pack(x) for x in np.split(total, cuts)]
        seconds = [None] * len(sizes) if second is None else [pack(x) for x in np.split(second, cuts)]
        rows = zip(table.column("block").to_pylist(), table.column("bucket").to_pylist(), [kind] * len(sizes), firsts, seconds)
        return rows_of(TOLD, list(rows))

    return asked.groupBy("bucket").applyInArrow(bucket, TOLD)


def told(table: pa.Table, kind: str, hashes: np.ndarray, column: str, of: type) -> np.ndarray:
    """The answers to a block, in the order of its hashes."""
    own = table.filter(pc.equal(table.column("kind"), kind)).sort_by("bucket")
    values = np.empty(len(hashes), of)
    parts = [unpack(x, of) for x in own.column(column).to_pylist()]
    values[np.argsort(hashes, kind="stable")] = np.concatenate(parts) if parts else np.zeros(0, of)
    return values


# --- the model --------------------------------------------------------------------------------


def discounts(n: dict[int, int]) -> np.ndarray:
    """Factor of a count by the number ``n`` of entries of each count; item 0 is unused.

    Good-Turing's up to the largest bound of at most DISCOUNTED for which all lie
    between 0 and 1; with none, which only small corpora have, half a count is taken off.
    """
    for most in range(DISCOUNTED, 0, -1):
        if any(not n.get(r) for r in range(1, most + 2)):
            continue
        above = (most + 1) * n[most + 1] / n[1]
        if above >= 1:
            continue
        found = [((r + 1) * n[r + 1] / n[r] / r - above) / (1 - above) for r in range(1, most + 1)]
        if all(0 < d < 1 for d in found):
            return np.array([0.0, *found, *[1.0] * (DISCOUNTED - most)])
    return np.array([0.0, *[(r - 0.5) / r for r in range(1, DISCOUNTED + 1)]])


class Statistics:
    """What the whole corpus comes down to: a few numbers of the words and the pairs."""

    def __init__(self, rows: list, learned: int):
        #: Learned texts, which is how often START is a context.
        self.learned = learned
        n = {kind: {} for kind in ("words", "pairs")}
        total = {kind: [0, 0] for kind in n}
        for row in rows:
            if row["r"] == 0:
                total[row["kind"]] = [row["tokens"], row["n"]]
            else:
                n[row["kind"]][row["r"]] = row["n"]
        #: Learned tokens and distinct words among them.
        self.tokens, self.words = total["words"]
        self.word_factors, self.pair_factors = discounts(n["words"]), discounts(n["pairs"])
        lost = sum(n["words"].get(r, 0) * r * (1 - self.word_factors[r]) for r in range(1, DISCOUNTED + 1))
        #: Where no count is discounted, half a token is kept for unknown words.
        self.shrink = 1.0 if lost > 0 else self.tokens / (self.tokens + 0.5)
        self.unknown = (lost / self.tokens if lost > 0 else 0.5 / (self.tokens + 0.5)) if self.tokens else 1.0

    @staticmethod
    def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
        return counts * np.where(counts > DISCOUNTED, 1.0, factors[np.minimum(counts, DISCOUNTED)])

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        seen = self.discounted(counts, self.word_factors) / max(self.tokens, 1) * self.shrink
        return np.where(counts > 0, seen, self.unknown)


def statistics(answers: DataFrame, learned: int) -> Statistics:
    """Counts of counts, from the entries each block answers for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = unpack(blob, np.int64)
                counts = counts[counts > 0]
                low = np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 2)
                for r in range(DISCOUNTED + 2):
                    whole = n.setdefault((kind, r), [0, 0])
                    whole[0] += len(counts) if r == 0 else int(low[r])
                    whole[1] += int(counts.sum()) if r == 0 else 0
        yield from rows_of(schema, [(kind, r, *values) for (kind, r), values in n.items()]).to_batches()

    schema = T.StructType().add("kind", "string").add("r", "integer").add("n", "long").add("tokens", "long")
    parts = answers.select("kind", "a").mapInArrow(run, schema)
    return Statistics(parts.groupBy("kind", "r").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).collect(), learned)


class Answered:
    """A block with what the buckets told it."""

    def __init__(self, row: dict, answers: pa.Table, stats: Statistics):
        self.block = block = Block(row)
        self.stats, self.answers = stats, answers
        self.counts = np.abs(told(answers, "words", block.words, "a", np.int64))
        self.word_p = stats.word_probability(self.counts)
        self.known = self.counts > 0
        #: How often each word is a context: its tokens, as each but the end has a successor.
        self.as_context = self.counts.copy()
        self.as_context[START] = stats.learned
        pairs = told(answers, "pairs", block.pairs(), "a", np.int64)
        self.pair_counts, self.own = np.abs(pairs), pairs > 0
        self.pair_mass = stats.discounted(self.pair_counts, stats.pair_factors)

    def context_sums(self) -> tuple[np.ndarray, np.ndarray]:
        """By context, over the pairs this block answers for: their discounted counts, their words' probabilities."""
        own, context, size = self.own, self.block.context, len(self.block.words)
        return np.bincount(context[own], self.pair_mass[own], size), np.bincount(context[own], self.word_p[self.block.word[own]], size)

    def pair_logs(self) -> np.ndarray:
        """log10 P(word | context) of each distinct pair."""
        mass = told(self.answers, "sums", self.block.words, "a", np.float64)
        covered = told(self.answers, "sums", self.block.words, "b", np.float64)
        n = np.maximum(self.as_context, 1)
        # Where no successor is discounted, half a token is kept for the others.
        full = mass >= n * (1 - 1e-12)
        scale = np.where(full, n / (n + 0.5), 1.0)
        left = np.where(full, 0.5 / (n + 0.5), 1 - mass / n)
        backoff = np.where(mass > 0, left / (1 - covered), 1.0)
        context, word = self.block.context, self.block.word
        seen = scale[context] * self.pair_mass / n[context]
        return np.log10(np.where(self.pair_counts > 0, seen, backoff[context] * self.word_p[word]))

    def rows(self) -> list[list]:
        block, stats = self.block, self.stats
        base = np.log10((self.counts + 0.5) / (stats.tokens + 0.5 * (stats.words + 1)))
        return [
            block.ids,
            block.held_out,
            block.lengths,
            block.by_document(self.known[block.tokens].astype(np.int64)),
            np.full(len(block.lengths), stats.tokens),
            block.by_document(base[block.tokens]),
            block.by_document(self.pair_logs()[block.pair_of]),
        ]


def scores(rows: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's whole text under the model of the rows that are not ``held_out``.

    Columns: ``id_col``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``,
    ``train_tokens``, ``base_score`` (smoothed word frequencies) and ``score``, both
    log10. A null or empty text is its end alone. Repeated rows each count, in learning
    too; null ids keep their rows, other columns are not read. With nothing to learn
    from every token is of the one unknown class: score 0. An empty table gives an
    empty one.
    """
    spark = rows.sparkSession
    kept, work = Staging(spark), Staging(spark)
    asked = rows.select(named(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), named(text_col).alias("text"))
    blocks = work.keep(blocks_of(asked), "katz-blocks")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = sum(int(unpack(x, np.int64).sum()) for x in batch.column(0).to_pylist())
            learned = sum(int((unpack(x, np.uint8) == 0).sum()) for x in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([learned])], names=["tokens", "learned"])

    whole = blocks.select("lengths", "held_out").mapInArrow(sizes, "tokens long, learned long").agg(F.sum("tokens"), F.sum("learned")).first()
    total, learned = whole[0] or 0, whole[1] or 0
    buckets = max(1, -(-total // BUCKET_TOKENS))

    def asking(kind: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block = Block(batch.slice(i, 1).to_pylist()[0])
                    entries = (block.words, block.word_counts()) if kind == "words" else (block.pairs(), block.pair_counts())
                    yield from rows_of(ASKED, list(questions(block.name, *entries, None, buckets))).to_batches()

        return blocks.mapInArrow(run, ASKED)

    counts = work.keep(answered(asking("words"), "words"), "katz-words").unionAll(work.keep(answered(asking("pairs"), "pairs"), "katz-pairs"))
    stats = statistics(counts, learned)

    def summed(block: pa.Table, answers: pa.Table) -> pa.Table:
        met = Answered(block.to_pylist()[0], answers, stats)
        return rows_of(ASKED, list(questions(met.block.name, met.block.words, *met.context_sums(), buckets)))

    by_block = lambda frame: frame.groupBy("block")
    sums = by_block(blocks).cogroup(by_block(counts)).applyInArrow(summed, ASKED)
    sums = work.keep(answered(sums, "sums"), "katz-sums")

    out = T.StructType().add(id_col, rows.schema[id_col].dataType).add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long")
    out = out.add("train_tokens", "long").add("base_score", "double").add("score", "double")

    def scored(block: pa.Table, answers: pa.Table) -> pa.Table:
        met = Answered(block.to_pylist()[0], answers, stats)
        return pa.table([pa.array(v, arrow_type(f.dataType)) for v, f in zip(met.rows(), out)], names=out.names)

    result = kept.keep(by_block(blocks).cogroup(by_block(counts.unionAll(sums))).applyInArrow(scored, out), "katz-scores")
    work.drop()
    return result


HELD_OUT = 1
FOLDS = 5


def op4_katz_scores(spark, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir), fold("doc_id", FOLDS) == HELD_OUT)
