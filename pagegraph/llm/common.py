"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BLANKS = r"[\x20\x09-\x0D]+"

#: Texts of one step inside an Arrow batch: bounds what Python objects a task holds.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(named(id_col).cast("string"), F.lit(""))) % F.lit(modulus)


def blank_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; of null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value worked out once: a lambda names it, where plain nesting would repeat it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, or with underscores in front until it clashes with no taken name."""
    lowered = {name.lower() for name in taken}
    while wish.lower() in lowered:
        wish = "_" + wish
    return wish


#: Parts in which the rows of one group are ranked first.
RANK_PARTS = 64


def least_rows(rows: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each group, the least by ``order``, with their ``place`` from 1.

    Ranked in parts first, so that what meets for the final ranking of a group is at
    most RANK_PARTS times ``most`` rows, however many tasks and rows there are.
    """
    part = free_name(rows.columns, "_part")
    parts = rows.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(RANK_PARTS)))
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = parts.withColumn("place", place(group, part)).filter(F.col("place") <= most).drop("place", part)
    return first.withColumn("place", place(group)).filter(F.col("place") <= most)


def sliced(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most SLICE_ROWS rows and about SLICE_BYTES of text (or list items)."""
    column = batch.column(text_at)
    lengths = (pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length)(column).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        size += n or 0
        if size >= SLICE_BYTES or i + 1 - start >= SLICE_ROWS:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(lengths):
        yield batch.slice(start)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; of null: none."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Each text; of null: the empty one."""
    return ["" if v is None else v for v in column.to_pylist()]


#: For the texts of some rows, a list of values for each new field, in order.
Scorer = Callable[[pa.Array], list[list]]


def append_columns(rows: DataFrame, text_col: str, new: T.StructType, scorer: Callable[[], Scorer]) -> DataFrame:
    """``rows`` without the text, with the scorer's columns behind, one Arrow pass, no shuffle.

    ``scorer`` is called once a task and returns the function of a slice of texts.
    A column of ``rows`` that is named like a new one is left out.
    """
    added = {field.name.lower() for field in new}
    kept = [c for c in rows.columns if c != text_col and c.lower() not in added]
    types = [arrow_type(field.dataType) for field in new]
    out = T.StructType([f for f in rows.schema if f.name in kept] + list(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in batches:
            for part in sliced(batch, 0):
                values = score(part.column(0))
                arrays = part.columns[1:] + [pa.array(v, t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    source = rows.select(*[named(c).alias(f"c{i}") for i, c in enumerate([text_col, *kept])])
    return source.mapInArrow(run, out)


def keep_rows(rows: DataFrame, text_col: str, judge: Callable[[], Callable[[pa.Array], list[bool]]]) -> DataFrame:
    """The rows whose text ``judge`` accepts, every column as it is; one Arrow pass."""
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = judge()
        for batch in batches:
            for part in sliced(batch, at):
                yield part.filter(pa.array(accepts(part.column(at)), pa.bool_()))

    # Plain names inside: mapInArrow reads a dot in a name as a field of a struct.
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*rows.columns)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
