"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph hashes to a wide vector, a document's fingerprint is the sum of its
paragraphs' vectors, lane by lane modulo 2^32. The order of paragraphs does not
matter, and inserting or deleting a paragraph adds or subtracts its vector.

A vector has three parts, all of them additive:
  strong lanes  8 lanes from salted 64-bit hashes of the paragraph: they tell
                multisets of paragraphs apart;
  one lane      the number of its word shingles (3 words, or all of a shorter one);
  sign lanes    64 lanes, lane j counting the shingles whose hash has bit j set.
                Twice that minus the number is a sum of random signs a shingle, so
                the cosine of two such vectors is that of the shingle counts, within
                about 1/8: the likeness of two fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagegraph.llm.common import blank_words, bound, documents, named
from pagegraph.session import staged

SALTS = 4
STRONG = 2 * SALTS
SIGNS = 64
SHINGLE = 3
LOW = 0xFFFFFFFF
#: Bits k and k + 32 of a hash, moved to the low ends of two 32-bit counters in one sum.
PAIR = 0x0000000100000001


def low32(value: Column) -> Column:
    return value.bitwiseAND(F.lit(LOW).cast("long"))


def high32(value: Column) -> Column:
    return F.shiftrightunsigned(value, 32)


def paragraphs(text: Column) -> Column:
    """The lines of a text that have a word."""
    return F.filter(F.split(text, "\n"), lambda p: p.rlike(r"[^\x20\x09-\x0D]"))


def _shingles(words: Column) -> Column:
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - SHINGLE)
    full = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    return F.when(n >= SHINGLE, full).otherwise(F.array(F.xxhash64(words)))


def _lane(parts: Column, salt: int, half: Callable[[Column], Column]) -> Column:
    """One strong lane of a list of paragraphs: half of a salted hash, summed modulo 2^32.

    The salt comes first and seeds the hash of the paragraph, so that two paragraphs which
    collide under one salt need not under the next: lanes are no functions of one hash.
    """
    zero = F.lit(0).cast("long")
    return F.aggregate(parts, zero, lambda total, part: low32(total + half(F.xxhash64(F.lit(salt), part))))


def strong_lanes(text: Column) -> Column:
    lanes = [(salt, half) for salt in range(SALTS) for half in (low32, high32)]
    return bound(paragraphs(text), lambda parts: F.array(*[_lane(parts, *lane) for lane in lanes]))


def shingle_lanes(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and ``signs`` (the number lane and the sign lanes) of each distinct key with a shingle.

    Plain sums over the shingles, taken a task at a time before any shuffle; where
    ``rows`` lie by their keys already there is none. Texts must not be null.
    """
    key_columns = [named(k) for k in keys]
    hashes = F.flatten(F.transform(F.transform(paragraphs(named(text_col)), blank_words), _shingles))
    each = rows.select(*key_columns, F.explode(hashes).alias("_h"))
    pair = F.lit(PAIR).cast("long")
    sums = [F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(pair)).alias(f"_p{k}") for k in range(SIGNS // 2)]
    total = each.groupBy(*key_columns).agg(F.count("_h").alias("_n"), *sums)
    halves = [half(F.col(f"_p{k}")) for half in (low32, high32) for k in range(SIGNS // 2)]
    return total.select(*key_columns, F.array(low32(F.col("_n")), *halves).alias("signs"))


def joined_lanes(strong: Column, signs: Column) -> Column:
    """A fingerprint of its parts; no sign lanes: the text has no word."""
    none = F.array_repeat(F.lit(0).cast("long"), SIGNS + 1)
    return F.concat(strong, F.coalesce(signs, none))


def fingerprints(rows: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and ``lanes`` (STRONG + 1 + SIGNS longs below 2^32) of each distinct key.

    Rows of equal keys must have equal texts; they count once. A null text counts
    as empty: all lanes are 0. Key columns must not be null.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    once = rows.select(*[named(k) for k in keys], text.alias("_text")).dropDuplicates(keys)
    signs = shingle_lanes(once, keys, "_text")
    strong = once.select(*[named(k) for k in keys], strong_lanes(F.col("_text")).alias("_strong"))
    met = strong.join(signs, keys, "left")
    return met.select(*[named(k) for k in keys], joined_lanes(F.col("_strong"), F.col("signs")).alias("lanes"))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both documents' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: low32(x + y))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: low32(x - y + F.lit(1 << 32)))


def text_of(lanes: Column) -> Column:
    """A fingerprint as hex digits, 8 a lane."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the sign sums of two fingerprints, below 0 as 0; 1 if they are equal.

    A text without words is like another such text only.
    """

    def signs(lanes: Column) -> Column:
        n = F.get(lanes, F.lit(STRONG))
        return F.transform(F.slice(lanes, STRONG + 2, SIGNS), lambda x: (2 * x - n).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(signs(a), signs(a)) * dot(signs(b), signs(b)))
    cosine = F.when(norm > 0, dot(signs(a), signs(b)) / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def neighbours(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each distinct row of ``keys`` with the next and the previous one in ascending order, as a ring.

    Columns ``next`` and ``prev`` are structs of the keys. The keys are range-partitioned
    and written; only the first and last of each written range, one row a range, meet
    in one task. Null keys come first.
    """
    spread = rows.select(*[named(k) for k in keys]).distinct()
    ranged = spread.repartitionByRange(*[F.col(f"`{k}`").asc() for k in keys])
    ordered = staged(ranged.select(F.struct(*[named(k) for k in keys]).alias("k"), F.spark_partition_id().alias("part")), "key-order")
    inside = Window.partitionBy("part").orderBy("k")
    linked = ordered.select("k", "part", F.lead("k").over(inside).alias("after"), F.lag("k").over(inside).alias("before"))
    ends = ordered.groupBy("part").agg(F.min("k").alias("first"), F.max("k").alias("last"))
    across = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = Window.partitionBy(F.lit(0))
    joints = ends.select(
        "part",
        F.coalesce(F.lead("first").over(across), F.min(F.struct("part", "first")).over(whole)["first"]).alias("next_first"),
        F.coalesce(F.lag("last").over(across), F.max(F.struct("part", "last")).over(whole)["last"]).alias("prev_last"),
    )
    met = linked.join(joints, "part")
    return met.select("k.*", F.coalesce("after", "next_first").alias("next"), F.coalesce("before", "prev_last").alias("prev"))


KEYS = ["has_id", "id", "tie"]

#: Rows that one repeated document gives at a time.
COPIES = 10_000


def edited_fingerprints(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likenesses.

    Edited: the last quarter of the code points (rounded down) gives way to as many
    first ones of the next document by ascending id, the last being followed by the
    first. Rows equal in id and text are one document, worked out once and returned as
    often as they occur; different texts of one id follow each other by a hash of the
    text; null ids come first, null texts count as empty. A single document follows
    itself. An empty table gives an empty one. Columns other than the two are not read.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    nothing = F.lit(0).cast(rows.schema[id_col].dataType)
    keyed = rows.select(
        named(id_col).isNotNull().alias("has_id"),
        F.coalesce(named(id_col), nothing).alias("id"),
        F.xxhash64(text).alias("tie"),
        text.alias("text"),
    )
    sizes = staged(keyed.groupBy(*KEYS).agg(F.max(F.length("text")).alias("n"), F.count("*").alias("times")), "fp-sizes")
    ring = neighbours(sizes, KEYS)
    before = sizes.select(F.struct(*KEYS).alias("prev"), F.floor(F.col("n") / 4).cast("int").alias("lends"))
    order = staged(ring.join(before, "prev").join(sizes, KEYS), "fp-order")

    # A row a distinct document, laid out by its key; every later step but one keeps that layout.
    met = keyed.dropDuplicates(KEYS).join(order, KEYS)
    heads = met.select("prev.*", F.substring(F.col("text"), F.lit(1), F.col("lends")).alias("head"))
    stays = F.substring(F.col("text"), F.lit(1), (F.col("n") - F.floor(F.col("n") / 4)).cast("int"))
    both = met.join(heads, KEYS).select(*KEYS, "n", "times", "next", "text", F.concat(stays, F.col("head")).alias("edited"))
    versions = both.select(*KEYS, F.inline(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")))))
    signs = shingle_lanes(versions, [*KEYS, "version"], "body")
    of = lambda version: F.max(F.when(F.col("version") == version, F.col("signs")))
    signs = signs.groupBy(*KEYS).agg(of(0).alias("signs"), of(1).alias("edited_signs"))
    told = both.select(
        *KEYS, "n", "times", "next",
        strong_lanes(F.col("text")).alias("strong"),
        strong_lanes(F.col("edited")).alias("edited_strong"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    made = told.join(signs, KEYS, "left").select(
        *KEYS, "n", "times", "next", "edited_sha256",
        joined_lanes(F.col("strong"), F.col("signs")).alias("lanes"),
        joined_lanes(F.col("edited_strong"), F.col("edited_signs")).alias("edited_lanes"),
    )
    made = staged(made, "fp-lanes")
    after = made.select(F.struct(*KEYS).alias("next"), F.col("lanes").alias("next_lanes"))
    out = made.join(after, "next").select(
        F.when(F.col("has_id"), F.col("id")).alias(id_col),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        text_of(F.col("lanes")).alias("fingerprint"),
        text_of(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / COPIES))).alias("_lot"),
        "times",
    )
    here = F.least(F.lit(COPIES).cast("long"), F.col("times") - F.col("_lot") * COPIES)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), here))).drop("_lot", "_copy", "times")


def op2_fingerprint_multiset(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))
