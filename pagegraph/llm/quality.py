"""Quality rules as a ledger of bits.

Every rule is evaluated once a document: its measurement goes into a column, its
failure into one bit of ``failed_bits``. Policies are versioned masks over those
bits, so a verdict, another policy's verdict or an ablation (what a rule rejects
alone) is arithmetic on the ledger, never a second look at the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.llm.common import BLANKS, blank_words, bound, documents, free_name, named

#: Words of a window whose second occurrence in a text marks its words as repeated.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition on the measurement columns; the place in RULES is the bit."""

    name: str
    fails: str


#: Only append: a rule's place is its bit in ledgers already written.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("few_letters", "2 * n_letter_words < n_words"),
    Rule("huge", "n_words > 1000000"),
)
BASE = ("few_words", "repeated_windows")

#: Versions of the policy: the rules whose failure rejects. Versions stay as they are once used.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "many_symbols", "duplicate_lines", "short_words", "long_words", "few_letters"),
}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_letter_words", "n_repeat_words")


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(1 << i for i, rule in enumerate(RULES) if rule.name in POLICIES[policy])


def _window_hashes(words: Column, size: int) -> Column:
    """A hash of each run of ``size`` words, from the hashes of the words; none if there are fewer."""

    def of(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - size)
        return F.when(F.size(hashes) >= size, F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)])))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), of)


def _covered(hashes: Column, size: int) -> Column:
    """Words lying in windows whose hash occurs twice or more.

    Sorting (hash, start) brings equal windows together; the starts of those with
    an equal neighbour, in order, each cover ``size`` words or up to the next start.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts_in(sorted_pairs: Column) -> Column:
        def has_twin(x: Column, i: Column) -> Column:
            before = F.get(sorted_pairs, i - 1)["h"].eqNullSafe(x["h"])
            return before | F.get(sorted_pairs, i + 1)["h"].eqNullSafe(x["h"])

        return F.array_sort(F.transform(F.filter(sorted_pairs, has_twin), lambda x: x["i"]))

    def total(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, i: F.least(F.lit(size), F.coalesce(F.get(starts, i + 1) - s, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return bound(bound(pairs, starts_in), total)


def ledger(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the measurements and ``failed_bits`` of every row, in one pass without shuffle.

    A null text counts as empty: it has no words and fails ``few_words`` alone.
    Repeated rows and null ids each keep a row, other columns are not read, an
    empty table gives an empty ledger. Very long texts stay within one row's arrays.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    key, words, hashes = (free_name([id_col, *MEASURES], n) for n in ("_id", "_words", "_hashes"))
    split = rows.select(named(id_col).alias(key), text.alias("_text")).select("*", blank_words(F.col("_text")).alias(words))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measured = split.select(
        named(key),
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.size(F.filter(named(words), lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        _window_hashes(named(words), WINDOW).alias(hashes),
    )
    twins = F.size(F.array_distinct(named(hashes))) < F.size(named(hashes))
    measured = measured.select(
        named(key),
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_letter_words",
        F.when(twins, _covered(named(hashes), WINDOW)).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    bits = [F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.select(named(key).alias(id_col), *MEASURES, failed.alias("failed_bits"))


def fails(policy: str = CURRENT) -> Column:
    """Whether a row of the ledger fails a rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """One row a rule of the policy: documents that fail it, and that it alone rejects.

    ``common_bits`` are the bits that all rejected documents share, ``any_bits`` those that any has.
    """
    bits = mask(policy)
    held = book.select(F.col("failed_bits").bitwiseAND(F.lit(bits).cast("long")).alias("b"))
    rules = [(r.name, 1 << i) for i, r in enumerate(RULES) if bits >> i & 1]
    sums = [F.count(F.when(F.col("b").bitwiseAND(F.lit(bit).cast("long")) != 0, 1)).alias(f"f_{name}") for name, bit in rules]
    sums += [F.count(F.when(F.col("b") == bit, 1)).alias(f"a_{name}") for name, bit in rules]
    rejected = F.when(F.col("b") != 0, F.col("b"))
    total = held.agg(*sums, F.bit_and(rejected).alias("common_bits"), F.bit_or(rejected).alias("any_bits"), F.count("*").alias("n_rows"))
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"f_{name}").alias("failed"), F.col(f"a_{name}").alias("alone")) for name, _ in rules])
    return total.select(F.lit(policy).alias("policy"), F.inline(each), "n_rows", "common_bits", "any_bits")


def op8_quality_ledger(spark, sf_dir: str) -> DataFrame:
    book = ledger(documents(spark, sf_dir))
    base = F.col("failed_bits").bitwiseAND(F.lit(mask("v1")).cast("long")) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~fails()).alias("kept"), "failed_bits")


OP8_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)),
twins AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(next_i - i, 8)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next_i FROM twins) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_letter_words,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)),
bits AS (
  SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
      + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines)::INT
      + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
      + 64 * (2 * n_letter_words < n_words)::INT + 128 * (n_words > 1000000)::INT)::BIGINT AS failed_bits
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, (failed_bits & 127) = 0 AS kept, failed_bits
FROM bits
"""
