"""Rows by keys: which are among some, and one row of each.

Both leave other columns where they are: rows that are surely none of those sought
pass a Bloom filter over their keys without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.session import staged

# A block of the filter: 512 words of 64 bits, in which a key sets so many bits.
WORDS = 512
BITS_A_KEY = 4
#: Keys to a block, 8 bits for each: about one other key in forty hits all its bits.
KEYS_A_BLOCK = WORDS * 64 // 8
#: Blocks sent to every executor at most, 64 MB in all, enough for 67 million keys; beyond, blocks
#: are fuller and more rows are compared with the exact list. No row is lost or kept by the filter.
MOST_BLOCKS = 1 << 14
MAYBE = "_maybe"


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _places(keys: list[str]) -> list[Column]:
    """The bits of a key in its block, from parts of a second hash."""
    h = F.xxhash64(F.lit("place"), *keys)
    return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(WORDS * 64 - 1)).cast("int") for i in range(BITS_A_KEY)]


def _filter_blocks(members: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """``block`` and its ``words``. A key is one row in the shuffle, whatever its bits."""
    placed = members.select(_block(keys, blocks).alias("block"), F.array(*_places(keys)).alias("places")).repartition("block")
    bits = placed.select("block", F.explode("places").alias("place"))
    word, bit = F.expr("place div 64").cast("int"), F.expr("shiftleft(1L, cast(place % 64 AS int))")
    by_word = bits.groupBy("block", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    told = by_word.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("told"))
    return told.select("block", F.expr(f"transform(sequence(0, {WORDS - 1}), i -> coalesce(try_element_at(told, i), 0L))").alias("words"))


def maybe_among(rows: DataFrame, members: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``rows`` with MAYBE: false only where its keys are surely none of the ``n`` ``members``."""
    blocks = min(-(-max(n, 1) // KEYS_A_BLOCK), MOST_BLOCKS)
    asked = rows.withColumns({"_asked_block": _block(keys, blocks), "_places": F.array(*_places(keys))})
    filters = _filter_blocks(members, keys, blocks).select(F.col("block").alias("_asked_block"), F.col("words").alias("_words"))
    met = asked.join(F.broadcast(filters), "_asked_block", "left")
    hit = F.expr("forall(_places, p -> bit_get(_words[cast(p div 64 AS int)], cast(p % 64 AS int)) = 1)")
    return met.withColumn(MAYBE, F.coalesce(hit, F.lit(False))).drop("_asked_block", "_places", "_words")


def split_by(rows: DataFrame, members: DataFrame, keys: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are none of ``members`` (a staged list of ``n`` distinct ones), and the others."""
    tested = maybe_among(rows, members, keys, n)
    hits = tested.filter(F.col(MAYBE))
    out = tested.filter(~F.col(MAYBE)).unionByName(hits.join(members, keys, "left_anti"))
    return out.select(*rows.columns), hits.join(members, keys, "left_semi").select(*rows.columns)


def one_of_each(rows: DataFrame, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """One of the rows that share ``keys``: the least by ``order``, then by a hash of the row.

    Keys are counted first; where none is repeated, ``rows`` come back as they are. Otherwise
    only rows of repeated keys are moved, and the choice is the same in every run. A
    row with a null key is left alone.
    """
    counted = rows.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = staged(counted.filter("n > 1").dropna(subset=keys).select(*keys), "repeated")
    n = repeated.count()
    if not n:
        return rows
    single, several = split_by(rows, repeated, keys, n)
    # Equal rows are as good as each other; others differ in their hash or else in a column.
    ordered = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    parts = [F.col(c).alias(f"_r{i}") for i, c in enumerate(rows.columns)]
    place = F.struct(*ordered, F.xxhash64(*rows.columns).alias("_h"), *parts)
    chosen = several.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(place).alias("_row"))
    return single.unionByName(chosen.select(*[F.col("_row")[f"_r{i}"].alias(c) for i, c in enumerate(rows.columns)]))
