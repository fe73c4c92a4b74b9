"""Vectors of integers, held in blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one block, which is what a task holds as one matrix.
BLOCK_ROWS = 4096


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def whole(vector: Column) -> Column:
    """Whether a vector is there and every entry of it is a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vector.isNotNull() & finite


def scaled(vector: Column, factor: int) -> Column:
    """Each entry as floor(factor * entry), worked out in doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))


def stacked(column: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as a matrix; a shorter one is filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    rows = np.zeros((len(lengths), width), np.int64)
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def narrowed(rows: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    for kind in (np.int8, np.int16, np.int32):
        span = np.iinfo(kind)
        if rows.size == 0 or (rows.min() >= span.min and rows.max() <= span.max):
            return rows.astype(kind)
    return rows


def packed(rows: np.ndarray) -> tuple[bytes, int]:
    """Bytes of a matrix and the bytes of one entry."""
    small = narrowed(rows)
    return small.tobytes(), small.itemsize


def unpacked(data: bytes, item: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"i{item}").reshape(-1, width)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most BLOCK_ROWS rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)
