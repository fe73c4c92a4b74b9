"""SimHash near-duplicate detection with BK-trees.

A text's 64-bit fingerprint takes each bit by majority over its word shingles'
hashes. Fingerprints are dealt to shards such that any two within the radius meet in
one; a shard's fingerprints form a BK-tree (children keyed by Hamming distance to the
parent) which is searched following only edges within the radius.

Trees of a whole corpus can't be broadcast, so a shard's tree stays with the task
that builds it and the shard's own fingerprints are its queries. The 64 bits make r + 1
blocks: two fingerprints within r bits agree on a block, whose value is their shard.
Values of a block that too many fingerprints share are cut further by r + 1 blocks of
their other bits, which is as exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.llm.common import Scorer, append_columns, documents, free_name, named, raw_texts
from pagegraph.llm.components import components
from pagegraph.session import staged

SEED = 42
BITS = 64
#: Fingerprints of a shard's tree, about; a shared block value is cut further beyond it.
SHARD_ROWS = 4096
#: Shingles whose bits are counted, or queries that are searched, at a time.
CHUNK = 1 << 15
QUERIES = 1024


def shingle_hashes(raw: bytes, words_each: int) -> np.ndarray:
    """XXH64 of each shingle of the ASCII-lowered words, repeats included; of a shorter text: its words together."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = zip(*(words[i:] for i in range(words_each))) if len(words) >= words_each else [words]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(run), SEED) for run in runs), np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class BKTree:
    """A BK-tree over distinct 64-bit values, built and searched a level at a time."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        parent = np.zeros(n, np.int64)
        keys, nodes = [], []
        waiting, root = np.arange(1, n), np.zeros(max(n - 1, 0), np.int64)
        while len(waiting):
            apart = np.bitwise_count(values[waiting] ^ values[root]).astype(np.int64)
            edge = root * (BITS + 1) + apart
            # The first of those on a new edge becomes its node, the others wait below it.
            edges, first, place = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(edges)
            nodes.append(waiting[first])
            parent[waiting[first]] = root[first]
            stays = np.ones(len(waiting), bool)
            stays[first] = False
            root, waiting = waiting[first][place][stays], waiting[stays]
        keys_all = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        nodes_all = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        order = np.argsort(keys_all)
        self.edges, self.children = keys_all[order], nodes_all[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in ``queries``, node) at most ``radius`` apart, in parts.

        Goes down from a node at distance d only by edges d - radius to d + radius.
        """
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        if not len(self.values):
            return
        while len(query):
            apart = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = apart <= radius
            if hit.any():
                yield query[hit], node[hit]
            if not len(self.edges):
                return
            low = np.searchsorted(self.edges, node * (BITS + 1) + np.maximum(apart - radius, 0))
            high = np.searchsorted(self.edges, node * (BITS + 1) + np.minimum(apart + radius, BITS), side="right")
            n = high - low
            query = np.repeat(query, n)
            steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            node = self.children[np.repeat(low, n) + steps]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Give linked places the least label of their group."""
    while True:
        least = np.minimum(labels[a], labels[b])
        after = labels.copy()
        np.minimum.at(after, labels[a], least)
        np.minimum.at(after, labels[b], least)
        after = after[after]
        if np.array_equal(after, labels):
            return labels
        labels = after


def block_masks(radius: int, depth: int = 3) -> list[int]:
    """Masks of a tree of blocks: r + 1 of all bits, and below each block r + 1 of the bits not fixed yet.

    The children of block k are (r + 1) * (k + 1) on.
    """
    ways = radius + 1

    def cut(bits: list[int]) -> list[list[int]]:
        return [part.tolist() for part in np.array_split(bits, ways)]

    level = [(part, [b for b in range(BITS) if b not in part]) for part in cut(list(range(BITS)))]
    masks = [part for part, _ in level]
    for _ in range(depth - 1):
        level = [(part, [b for b in rest if b not in part]) for _, rest in level for part in cut(rest)]
        masks += [part for part, _ in level]
    return [signed(sum(1 << b for b in part)) for part in masks]


def shard_links(fps: DataFrame, radius: int, depth: int = 3) -> DataFrame:
    """``u`` and ``v``: links by which fingerprints (``fp``, distinct) within ``radius`` bits hang together.

    Complete: any two within the radius share a shard, and a shard returns a star for
    each of its groups, so no linked pair ends up apart and no group is listed pair by
    pair. A shard holds about SHARD_ROWS fingerprints; a key that more share is cut by
    blocks of the remaining bits, down to ``depth`` blocks, after which 19 free bits
    (for radius 2) bound it.
    """
    masks, ways = block_masks(radius, depth), radius + 1
    mask = lambda block: F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), block + 1)

    def keyed(rows: DataFrame, blocks: list) -> DataFrame:
        """Each row under the key of each block, the key of the block above hashed in."""
        cut = rows.withColumn("block", F.explode(F.array(*blocks)))
        return cut.withColumn("key", F.xxhash64("key", "block", F.col("fp").bitwiseAND(mask(F.col("block"))))).select("fp", "key", "block")

    rows = keyed(fps.select("fp", F.lit(0).cast("long").alias("key")), [F.lit(k) for k in range(ways)])
    settled = None
    for level in range(depth):
        if level == depth - 1:
            found = rows
        else:
            rows = staged(rows, "shard-keys")
            hot = staged(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD_ROWS).select("key"), "hot-keys")
            if hot.isEmpty():
                found = rows
            else:
                found = rows.join(hot, "key", "left_anti")
                shared = rows.join(hot, "key", "left_semi")
        settled = found.select("fp", "key") if settled is None else settled.unionAll(found.select("fp", "key"))
        if found is rows:
            break
        rows = keyed(shared, [(F.col("block") + 1) * ways + k for k in range(ways)])
    shards = settled.withColumn("shards", F.lit(max(1, -(-ways * fps.count() // SHARD_ROWS))))
    dealt = shards.select("fp", F.pmod("key", "shards").alias("shard"))

    def links(table: pa.Table) -> pa.Table:
        values = np.unique(table.column("fp").to_numpy()).view(np.uint64)
        tree, labels = BKTree(values), np.arange(len(values))
        for start in range(0, len(values), QUERIES):
            for query, node in tree.within(values[start : start + QUERIES], radius):
                other = query + start != node
                labels = merge_labels(labels, query[other] + start, node[other])
        own = np.flatnonzero(labels != np.arange(len(values)))
        return pa.table({"u": values[own].view(np.int64), "v": values[labels[own]].view(np.int64)})

    return dealt.groupBy("shard").applyInArrow(links, "u long, v long")


def fingerprinted(rows: DataFrame, text_col: str, words_each: int) -> DataFrame:
    """``rows`` without the text, with ``fp``: the SimHash as a signed long; 0 for a text without words."""

    def scorer() -> Scorer:
        return lambda column: [[signed(simhash(shingle_hashes(raw, words_each))) for raw in raw_texts(column)]]

    return append_columns(rows, text_col, T.StructType().add("fp", "long"), scorer)


def fingerprint_roots(prints: DataFrame, radius: int) -> DataFrame:
    """``fp`` and ``root``: every distinct fingerprint with one that stands for its component."""
    nodes = staged(prints.select("fp").distinct(), "distinct-prints")
    stars = components(shard_links(nodes, radius))
    return nodes.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def linked(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_each: int = 3, radius: int = 2) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Texts whose fingerprints differ in at most ``radius`` bits are linked, directly or
    through others; ``component_id`` is the least id of those linked, null only if all
    their ids are. A null text counts as empty; texts without words have fingerprint 0
    and link like others. Of a long text all shingles count. Repeated rows and ids keep a row each, other columns are not
    read, an empty table gives an empty one.
    """
    prints = staged(fingerprinted(rows.select(named(id_col).alias("_id"), named(text_col).alias("_text")), "_text", words_each), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("_id").alias("least")), "distinct-fingerprints")
    grouped = nodes.join(fingerprint_roots(nodes, radius), "fp")
    leasts = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = staged(grouped.join(leasts, "root").select("fp", "component_id"), "components")
    met = prints.join(by_print, "fp")
    return met.select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_simhash_components(spark, sf_dir: str) -> DataFrame:
    return linked(documents(spark, sf_dir))


def keep_one(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_each: int = 3, radius: int = 2) -> DataFrame:
    """One row, whole, of each component of ``linked``: the one with the least id.

    A null id comes last. Of rows equal in id the least by a hash of the whole row stays,
    so every run keeps the same; of rows equal in all columns one. A null text counts as
    empty, and texts without words form one group with all whose fingerprint is near
    zero. An empty table gives an empty one; of a long text all words count.
    """
    whole = F.xxhash64(*[named(f.name) for f in rows.schema if not isinstance(f.dataType, T.MapType | T.VariantType)])
    narrow = rows.select(named(id_col).alias("id"), whole.alias("h"), named(text_col).alias("_text"))
    prints = staged(fingerprinted(narrow, "_text", words_each), "fingerprints")
    roots = staged(fingerprint_roots(prints, radius), "fingerprint-roots")
    lead = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h"))
    # Cut down to a row a fingerprint first, so that no group's rows meet in one task.
    by_print = prints.groupBy("fp").agg(lead.alias("lead"), F.count("*").alias("n"))
    groups = by_print.join(roots, "fp").groupBy("root").agg(F.min("lead").alias("lead")).select(F.col("lead.id").alias("keep_id"), F.col("lead.h").alias("keep_h"))
    times = prints.groupBy(F.col("id").alias("times_id"), F.col("h").alias("times_h")).agg(F.count("*").alias("times")).filter("times > 1")
    repeated = F.col("keep_id").eqNullSafe(F.col("times_id")) & (F.col("keep_h") == F.col("times_h"))
    chosen = staged(groups.join(times, repeated, "left").select("keep_id", "keep_h", F.col("times").isNotNull().alias("again")), "kept-rows")

    kept = {c: free_name([*rows.columns, "keep_id", "keep_h", "again"], f"_{i}") for i, c in enumerate(rows.columns)}
    plain = rows.select(*[named(c).alias(new) for c, new in kept.items()], whole.alias("_h"))
    stays = plain.join(chosen, named(kept[id_col]).eqNullSafe(F.col("keep_id")) & (F.col("_h") == F.col("keep_h")))
    # Only rows equal in every column are there more than once.
    once = stays.filter(~F.col("again")).unionAll(stays.filter("again").dropDuplicates([kept[id_col], "_h"]))
    return once.select(*[named(new).alias(c) for c, new in kept.items()])
