"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source the keys are cut into ranges;
word counts summed by range, then over the ranges, are the distributed prefix
sums. The range that holds the source's budget is sorted and cut at the exact
word; ranges before it are taken whole, ranges behind it not at all. A budget
above the source's size repeats the whole source first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pagegraph.llm.common import blank_words, documents, free_name, named
from pagegraph.session import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

#: Hex digits of a key that name its range: 4,096 ranges a source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.size(blank_words(text)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add ``target`` to one row a source (``source_key``, ``source_size``).

    Sources by code point, null last, weigh ``weights`` in turn and share ``share``
    times all words; no target passes ``most`` times its source's size, and what is
    above is shared anew by weight. That end point is one water level: sources in
    order of size over weight fill up first, and the level is what remains divided
    by the weights that remain. One row a source, so one task can order them.
    """
    n = len(weights)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source_key") == "n", "source_key")
    weighed = sizes.withColumn("_turn", (F.row_number().over(order) - 1) % n)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("_turn") + 1)
    weighed = weighed.withColumn("weight", weight).withColumn("_full", F.col("source_size") * most)
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("_full") / F.col("weight"), F.col("source_key"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(0))
    filled = (
        weighed.withColumn("_below", F.coalesce(F.sum("_full").over(before), F.lit(0)))
        .withColumn("_left", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_total", F.sum("source_size").over(all_rows))
    )
    level = (F.lit(share) * F.col("_total") - F.col("_below")) / F.col("_left")
    # A source is full when the level over it and all behind it reaches its bound.
    filled = filled.withColumn("_level", level).withColumn("_is_full", level * F.col("weight") >= F.col("_full"))
    open_level = F.max(F.when(~F.col("_is_full"), F.struct(-F.col("_full") / F.col("weight"), F.col("_level")))).over(all_rows)
    target = F.when(F.col("_is_full"), F.col("_full").cast("double")).otherwise(open_level["_level"] * F.col("weight"))
    return filled.select("source_key", "source_size", target.alias("target"))


def mix(rows: DataFrame, size_col: str, id_col: str = "doc_id", source_col: str = "source", *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, tie: Column | None = None) -> DataFrame:
    """All columns of ``rows`` and ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words the mix takes from the row, repeats included: whole
    rounds of the source, then the rows up to the budget in key order, of the last
    row only the words still missing, so each source's sum is its target rounded.
    Null sources are a source of their own, null ids hash as empty text, rows
    without words take nothing, repeated rows count each. Reruns agree: equal keys
    order by id, size and ``tie``. An empty table gives an empty one. A column
    named like a new one is replaced. Of a long text all words count. An id that many
    rows share, a null one too, is no task's work alone.
    """
    outputs = ("source_size", "target", "taken")
    kept = [c for c in rows.columns if c.lower() not in outputs]
    key, part, source, size = (free_name([*kept, *outputs], n) for n in ("_key", "_range", "source_key", "_size"))
    hashed = F.md5(F.concat(F.lit("mix:"), F.coalesce(named(id_col).cast("string"), F.lit(""))).cast("binary"))
    keyed = rows.select(
        *[named(c) for c in kept],
        F.coalesce(named(size_col), F.lit(0)).cast("long").alias(size),
        hashed.alias(key),
        F.coalesce(F.concat(F.lit("s"), named(source_col)), F.lit("n")).alias(source),
    ).withColumn(part, F.substring(named(key), 1, RANGE_DIGITS))

    ranges = keyed.groupBy(named(source).alias("source_key"), named(part).alias("range")).agg(F.sum(named(size)).alias("range_size"))
    ranges = staged(ranges, "mix-ranges")
    sizes = ranges.groupBy("source_key").agg(F.sum("range_size").alias("source_size"))
    targets = (
        source_targets(sizes, weights, share, most)
        .withColumn("budget", F.round("target").cast("long"))
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("rounds") * F.col("source_size"))
    )
    # One row a source: the range in which its rest runs out, and what is left there.
    prefix = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        ranges.withColumn("before", F.coalesce(F.sum("range_size").over(prefix), F.lit(0)))
        .join(targets, "source_key")
        .groupBy("source_key", "source_size", "target", "rounds", "rest")
        .agg(F.max(F.when(F.col("before") <= F.col("rest"), F.struct("range", "before"))).alias("cut"))
        .select(F.col("source_key").alias("_cut_source"), "source_size", "target", F.col("rounds").alias("_rounds"), F.col("cut.range").alias("_cut"), (F.col("rest") - F.col("cut.before")).alias("_missing"))
    )
    met = keyed.join(staged(cuts, "mix-cuts"), named(source) == F.col("_cut_source"))
    whole = F.col("_rounds") * named(size)
    apart = met.filter(named(part) != F.col("_cut")).withColumn("taken", F.when(named(part) < F.col("_cut"), whole + named(size)).otherwise(whole))
    # The rows of the range at the cut, most often few; where one id has many of them, they
    # are dealt in runs of their order, of which equal rows may fill several.
    at_cut = staged(met.filter(named(part) == F.col("_cut")), "mix-cut-rows")
    run, salt = free_name([*met.columns, *outputs], "_run"), free_name([*met.columns, *outputs], "_salt")
    order = [named(c) for c in (key, id_col, size)] + ([tie] if tie is not None else [])
    runs = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = at_cut.withColumn(salt, F.monotonically_increasing_id())  # of a written table: the same when read again
    dealt = staged(numbered.repartitionByRange(runs, named(source), *order, named(salt)).withColumn(run, F.spark_partition_id()), "mix-cut-runs")
    by_run = dealt.groupBy(F.col("_cut_source").alias("run_source"), named(run).alias("run_number")).agg(F.sum(named(size)).alias("run_size"))
    earlier = Window.partitionBy("run_source").orderBy("run_number").rowsBetween(Window.unboundedPreceding, -1)
    by_run = by_run.select("run_source", "run_number", F.coalesce(F.sum("run_size").over(earlier), F.lit(0)).alias("run_before"))
    inside = Window.partitionBy(named(source), named(run)).orderBy(*order, named(salt)).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum(named(size)).over(inside), F.lit(0)))
    placed = placed.join(by_run, (F.col("_cut_source") == F.col("run_source")) & (named(run) == F.col("run_number")))
    left = F.col("_missing") - F.col("run_before") - F.col("_inside")
    cut = placed.withColumn("taken", whole + F.greatest(F.lit(0), F.least(named(size), left)))
    columns = [*[named(c) for c in kept], F.col("source_size"), F.col("target"), F.col("taken").cast("long").alias("taken")]
    return apart.select(*columns).unionAll(cut.select(*columns))


def repeated(mixed: DataFrame, text_col: str, size_col: str, columns: list[str], chars_col: str | None = None) -> DataFrame:
    """``columns`` of the mix as rows: a whole copy a round, and of the row at the cut its first words.

    ``chars_col`` (if among the columns) is set to the length of a text so cut.
    """
    size, taken = named(size_col), F.col("taken")
    whole = F.floor(taken / size)
    copy, part = free_name(mixed.columns, "_copy"), free_name(mixed.columns, "_part")
    rows = mixed.filter((taken > 0) & (size > 0)).withColumn(part, taken - whole * size)
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.ceil(taken / size).cast("int"))))
    is_cut = named(copy) > whole
    head = F.array_join(F.slice(blank_words(named(text_col)), F.lit(1), named(part).cast("int")), " ")
    shown = {text_col: F.when(is_cut, head).otherwise(named(text_col))}
    if chars_col in columns:
        kind = mixed.schema[chars_col].dataType
        shown[chars_col] = F.when(is_cut, F.length(head).cast(kind)).otherwise(named(chars_col))
    return rows.select(*[shown.get(c, named(c)).alias(c) for c in columns])


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents`` mixed: sizes first, as a narrow table, so the text is read once."""
    sized = staged(documents(spark, sf_dir).select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    return mix(sized, "size").select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key, coalesce('s' || source, 'n') AS source_key
  FROM documents),
sizes AS (SELECT source_key, sum(size)::BIGINT AS source_size FROM sized GROUP BY source_key),
weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source_key = 'n', source_key) - 1) % 3 + 1]::BIGINT AS weight, source_size * 2 AS most
  FROM sizes),
filled AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM sizes)::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / ((SELECT sum(weight) FROM weighed)
      - coalesce(sum(weight) OVER (ORDER BY most::DOUBLE / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM weighed),
targets AS (
  SELECT source_key, source_size,
         CASE WHEN level * weight >= most THEN most::DOUBLE
              ELSE (SELECT level FROM filled WHERE level * weight < most ORDER BY most::DOUBLE / weight, level DESC LIMIT 1) * weight END AS target
  FROM filled),
placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized JOIN targets USING (source_key))
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM placed
"""
