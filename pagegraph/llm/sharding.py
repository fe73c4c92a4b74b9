"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A stable key alone decides a row's shard for any number of shards, with no ring
table; with one shard more, only the rows that the new shard needs move, and only
into it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagegraph.llm.common import documents, free_name, named
from pagegraph.session import staged

SHARDS = 24
MULTIPLIER = np.uint64(2862933555777941757)

#: Key bits that name the range of a shard in which slots are counted: 4,096 ranges.
RANGE_BITS = 12
#: Rows of a range that are numbered together, about.
CROWD = 1 << 16
KEY_BITS = 60


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key; a few rounds for all keys at once."""
    keys = keys.astype(np.uint64)
    shard = np.zeros(len(keys), np.int64)
    at = np.arange(len(keys))
    while len(at):
        keys = keys * MULTIPLIER + np.uint64(1)
        steps = (keys >> np.uint64(33)).astype(np.float64) + 1.0
        after = ((shard[at] + 1) * (2147483648.0 / steps)).astype(np.int64)
        goes_on = after < shards
        at, keys = at[goes_on], keys[goes_on]
        shard[at] = after[goes_on]
    return shard


def stable_key(id_col: str) -> Column:
    """60 bits of the md5 of the id as text; a null id counts as empty text."""
    text = F.coalesce(named(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards), dtype="int32")

    return of(key)


def shard(rows: DataFrame, id_col: str = "doc_id", shards: int = SHARDS, order: list[Column] | None = None) -> DataFrame:
    """All columns of ``rows`` and ``shard``, ``slot``, ``grown_shard``.

    ``slot`` numbers the rows of a shard from 0 without gaps, by key, id and
    ``order``; it is counted in ranges of the key and the ranges are added up, so no
    shard is one task's work. Nor is an id that many rows share: a range beyond CROWD rows is
    numbered in pieces. ``grown_shard`` is the shard with one shard more.
    Rows of equal id (nulls too) lie in one shard. An empty table gives an empty
    one. A column named like a new one is replaced.
    """
    outputs = ("shard", "slot", "grown_shard")
    kept = [c for c in rows.columns if c.lower() not in outputs]
    key, part = (free_name([*kept, *outputs, "_before"], n) for n in ("_key", "_range"))
    keyed = rows.select(*[named(c) for c in kept], stable_key(id_col).alias(key))
    placed = keyed.select("*", shard_of(named(key), shards).alias("shard"), shard_of(named(key), shards + 1).alias("grown_shard"))
    placed = placed.withColumn(part, F.shiftright(named(key), KEY_BITS - RANGE_BITS))
    # Written, so that counting and numbering see the same rows in the same places.
    placed = staged(placed, "shard-keys")
    crowds = placed.groupBy("shard", named(part).alias("_part")).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > CROWD)
    crowds = staged(crowds.select(F.col("shard").alias("_shard"), "_part", F.ceil(F.col("_rows") / CROWD).alias("_pieces")), "shard-crowds")
    here = (F.col("shard") == F.col("_shard")) & (named(part) == F.col("_part"))
    number, place = (free_name([*kept, *outputs], n) for n in ("_piece", "_place"))
    # A range that one id fills is cut by the rows' places in the written table.
    placed = placed.withColumn(place, F.monotonically_increasing_id()).join(crowds, here, "left")
    placed = placed.withColumn(number, F.pmod(F.xxhash64(named(place)), F.coalesce("_pieces", F.lit(1)))).drop("_shard", "_part", "_pieces")
    counts = placed.groupBy("shard", named(part).alias("_part"), named(number).alias("_number")).agg(F.count("*").alias("_rows"))
    prefix = Window.partitionBy("shard").orderBy("_part", "_number").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("shard").alias("_shard"), "_part", "_number", F.coalesce(F.sum("_rows").over(prefix), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", named(part), named(number)).orderBy(named(key), named(id_col), *(order or []), named(place))
    numbered = placed.withColumn("slot", F.row_number().over(inside) - 1)
    met = numbered.join(starts, here & (named(number) == F.col("_number")))
    return met.select(*[named(c) for c in kept], "shard", (F.col("slot") + F.col("_before")).alias("slot"), "grown_shard")


def op3_shard_jump(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by the law of the key; the text is read once and never shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard(narrow, order=[F.col("size"), F.col("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
