"""NDJSON in, as VARIANT rows of any shape, and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagegraph.functions.text import trim_unicode
from pagegraph.operators.counts import Counts, how_many, watched
from pagegraph.session import shuffles_removed, staged


def parse_lines(lines: DataFrame, *keep: Column) -> DataFrame:
    """Text lines (``value``) as ``line, v`` and what is to be kept besides; blank lines
    are skipped and ``v`` is NULL where a line is not one JSON object.

    Each step passes through a generator: no filter on its result is moved below it, so
    a line is trimmed and parsed once whatever is asked of it.
    """
    kept = lines.select(F.explode(F.array(trim_unicode(F.col("value")))).alias("line"), *keep).filter(F.col("line") != "")
    parsed = F.when(F.startswith("line", F.lit("{")), F.try_parse_json("line"))
    return kept.select("*", F.inline(F.array(F.struct(parsed.alias("v")))))


def _or_fail(line: Column, v: Column) -> Column:
    """A condition that holds for good lines and fails the job at another. Rows are
    filtered by it whatever is read of them, where a column might be pruned."""
    message = F.concat(F.lit("not a JSON object: "), line)
    return F.when(v.isNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def read_ndjson(
    spark: SparkSession, path: str | list[str], on_bad: str = "fail", with_file: bool = False, counts: Counts | None = None
) -> DataFrame:
    """Rows of NDJSON files or folders as ``v VARIANT``, with their ``file`` if wanted.

    A line that is no JSON object fails the job, or with ``on_bad='quarantine'``
    is left out; ``rejected_lines`` lists those and ``counts`` gets ``lines_rejected`` in passing.
    """
    if on_bad not in ("fail", "quarantine"):
        raise ValueError("on_bad is 'fail' or 'quarantine'")
    files = [F.col("_metadata.file_path").alias("file")] if with_file else []
    rows = watched(parse_lines(spark.read.text(path), *files), counts, lines_rejected=how_many(F.col("v").isNull()))
    good = F.col("v").isNotNull() if on_bad == "quarantine" else _or_fail(F.col("line"), F.col("v"))
    return rows.filter(good).drop("line")


def rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_lines(spark.read.text(path)).filter(F.col("v").isNull()).select("line")


#: Rows of a compressed file at most: one task reads it whole.
ROWS_A_FILE = 500_000


def write_ndjson(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Overwrite ``path`` with one JSON object per row: columns in order, nulls
    written out, text as it is. ``compressed`` files (gzip) are read back like plain ones."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false").option("lineSep", "\n")
    if compressed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_A_FILE)
    with shuffles_removed(df.sparkSession):
        writer.json(path)


def write_ndjson_counted(df: DataFrame, path: str) -> int:
    """``write_ndjson`` that also gives the number of rows, counted as they pass."""
    written = Observation("written")
    write_ndjson(df.observe(written, F.count(F.lit(1)).alias("rows")), path)
    return written.get["rows"]


def write_posts(posts: DataFrame, path: str) -> None:
    """Write post rows, if any: without rows nothing is written, not even the folder."""
    posts = staged(posts, "posts")
    if not posts.isEmpty():
        write_ndjson(posts, path)
