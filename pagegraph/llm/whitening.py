"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The distinct rows x, centred by their mean m, are a matrix A with as many rows as
there are distinct vectors; it is never formed. Each step sends a short vector p to all
blocks of rows, works out u = A p there and sends back the sum of A'u; u itself is
never moved: it stays known as the p that makes it. Left and right vectors are both
orthogonalised against all earlier ones, twice. What comes out is A's bidiagonal form,
of the size of the steps taken, whose singular value decomposition is done on the driver.

What the driver holds are vectors as long as a row and as many as the steps, at most
the number of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.llm.common import named
from pagegraph.llm.vectors import embeddings, packed, runs, scaled, stacked, unpacked, whole
from pagegraph.session import Staging

#: Fixed by the contract of op11: entries are counted in 256ths, and so many components.
SCALE = 256
COMPONENTS = 4

#: Components count as found when what is left of them, against the greatest, is below this.
TOLERANCE = 1e-15
#: A direction is without variance when its length, or its share of the variance, is below this.
NO_VARIANCE = 1e-13
#: Up to so many dimensions a run ends only when no direction can have been missed, equal
#: eigenvalues included; beyond, when the components have converged.
COMPLETE_TO = 256


@dataclass
class Whitening:
    """Mean, components (a row each), their eigenvalues, and exact counts and sums."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    steps: int
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(len(self.sums))

    @property
    def projection(self) -> np.ndarray:
        """A column a component: centred rows times this are whitened."""
        return (self.components / np.sqrt(self.values)[:, None]).T


def blocks(vectors: DataFrame, width: int) -> DataFrame:
    """Distinct rows of ``x``, packed: ``data`` (a matrix's bytes) and ``item`` (bytes of an entry)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            data, item = packed(stacked(batch.column(0), width))
            yield pa.RecordBatch.from_pydict({"data": [data], "item": pa.array([item], pa.int32())})

    # Zeros at the end are as good as none, so that vectors are told apart as they are counted.
    filled = F.when(F.size("x") < width, F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))).otherwise(F.col("x"))
    return vectors.select(filled.alias("x")).distinct().mapInArrow(pack, "data binary, item int")


def _summed(table: DataFrame, width: int, work, names: str) -> dict[int, tuple]:
    """Sums over all blocks of the arrays ``work`` gives for one: a row a place of the arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = work(unpacked(data, item, width))
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total is not None:
            columns = [pa.array(t.tolist(), pa.float64() if t.dtype.kind == "f" else pa.int64()) for t in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total[0])), pa.int32()), *columns], names=["place", *names.split()])

    probe = work(np.zeros((0, width), np.int64))
    kinds = ["double" if t.dtype.kind == "f" else "long" for t in probe]
    schema = "place int, " + ", ".join(f"{name} {kind}" for name, kind in zip(names.split(), kinds, strict=True))
    sums = [F.sum(named(name).cast("decimal(38,0)") if kind == "long" else named(name)).alias(name) for name, kind in zip(names.split(), kinds, strict=True)]
    return {r[0]: tuple(r)[1:] for r in table.mapInArrow(run, schema).groupBy("place").agg(*sums).collect()}


def _exact(rows: np.ndarray) -> list[np.ndarray]:
    """Count, sum and sum of squares of a block's columns."""
    wide = rows.astype(np.int64)
    return [np.full(rows.shape[1], len(rows), np.int64), wide.sum(0), (wide * wide).sum(0)]


class _Matrix:
    """The centred rows, as an operator."""

    def __init__(self, table: DataFrame, width: int, mean: np.ndarray):
        self.table, self.width, self.mean = table, width, mean

    def there_and_back(self, p: np.ndarray) -> np.ndarray:
        """A'(A p): one pass over the blocks."""
        mean = self.mean

        def work(rows: np.ndarray) -> list[np.ndarray]:
            centred = rows - mean
            u = centred @ p
            return [centred.T @ u]

        found = _summed(self.table, self.width, work, "back")
        return np.array([found[i][0] for i in range(self.width)]) if found else np.zeros(self.width)


def _without(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis.T @ (basis @ vector)
    return vector


def bidiagonalise(matrix: _Matrix, wanted: int, square: float) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (a row a step) and the bidiagonal B of A = U B V', as far as ``wanted`` needs.

    ``square`` is the sum of A's squared entries. The left vectors are u_j = A p_j; their
    products with any A q are those of p_j with A'(A q), so p_j and A'u_j are kept.
    Where the vectors so far hold all they lead to, a new direction is begun.
    """
    width, nothing = matrix.width, NO_VARIANCE * np.sqrt(square)
    rng = np.random.default_rng(17)
    right, left, back = np.zeros((0, width)), np.zeros((0, width)), np.zeros((0, width))
    alphas, betas = [], []
    v = _unit(rng.standard_normal(width))
    while True:
        right = np.vstack([right, v])
        p, z = v, matrix.there_and_back(v)
        length = p @ z
        for again in (False, True):
            # u = A p without its part in earlier left vectors
            h = left @ z
            p, z = p - left.T @ h, z - back.T @ h
            if not again and p @ z < 1e-6 * length:
                z = matrix.there_and_back(p)  # little is left of u, and is worked out anew
        alpha = np.sqrt(max(p @ z, 0.0))
        if alpha > nothing:
            left, back = np.vstack([left, p / alpha]), np.vstack([back, z / alpha])
            w = _without(z / alpha - alpha * v, right)
            beta = np.linalg.norm(w)
        else:
            left, back = np.vstack([left, np.zeros(width)]), np.vstack([back, np.zeros(width)])
            alpha = beta = 0.0
        alphas.append(alpha)
        small = _bidiagonal(alphas, betas)
        if len(right) == width:
            return right, small
        u, s, _ = np.linalg.svd(small)
        # No direction outside V has more variance than V leaves over.
        beaten = len(s) >= wanted and (s[wanted - 1] ** 2 >= square - (small**2).sum() or width > COMPLETE_TO)
        if beaten and (beta * np.abs(u[-1, :wanted]) <= TOLERANCE * s[0]).all():
            return right, small
        if beta > nothing:
            v = w / beta
        else:
            beta, v = 0.0, _unit(_without(rng.standard_normal(width), right))
        betas.append(beta)


def _unit(vector: np.ndarray) -> np.ndarray:
    return vector / np.linalg.norm(vector)


def _bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)


def fit(table: DataFrame, width: int, wanted: int) -> Whitening:
    """Components of the packed rows ``table``, at most ``wanted`` and as many as have variance."""
    exact = _summed(table, width, _exact, "n total squares") if width else {}
    if not exact:
        return Whitening(0, [0] * width, 0.0, np.zeros(0), np.zeros((0, width)), 0)
    n = int(exact[0][0])
    sums = [int(exact[i][1]) for i in range(width)]
    trace = sum(n * int(exact[i][2]) - sums[i] ** 2 for i in range(width)) / n**2
    if trace == 0:
        return Whitening(n, sums, 0.0, np.zeros(0), np.zeros((0, width)), 0)
    matrix = _Matrix(table, width, np.array([s / n for s in sums]))
    right, small = bidiagonalise(matrix, wanted, trace * n)
    _, s, vt = np.linalg.svd(small)
    found = vt @ right
    keep = s[:wanted] ** 2 / n > NO_VARIANCE * trace
    components = found[:wanted][keep]
    components = components / np.linalg.norm(components, axis=1, keepdims=True)
    fitted = Whitening(n, sums, trace, s[:wanted][keep] ** 2 / n, components, len(right))
    fitted.identity_error = identity_error(table, width, fitted)
    return fitted


def identity_error(table: DataFrame, width: int, fitted: Whitening) -> float:
    """Largest entry, without sign, of the whitened rows' covariance minus the identity; one pass."""
    k, mean, projection = len(fitted.values), fitted.mean, fitted.projection

    def work(rows: np.ndarray) -> list[np.ndarray]:
        w = (rows - mean) @ projection
        return [np.concatenate([w.sum(0), (w.T @ w).ravel()])]

    found = _summed(table, width, work, "total")
    total = np.array([found[i][0] for i in range(k + k * k)]) / fitted.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, x: str, fitted: Whitening) -> DataFrame:
    """``rows`` with the longs ``x`` on the components: ``whitened array<double>``.

    Replaces a column of that name; a null vector gives null.
    """
    width, mean, projection = len(fitted.sums), fitted.mean, fitted.projection
    kept = [c for c in rows.columns if c.lower() != "whitened"]
    at = kept.index(x)
    out = T.StructType([rows.schema[c] for c in kept] + [T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            there = batch.column(at).is_valid().to_numpy(zero_copy_only=False)
            w = (stacked(batch.column(at).drop_null(), width) - mean) @ projection
            values = iter(w)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([next(values) if t else None for t in there], pa.list_(pa.float64()))],
                names=[*batch.schema.names, "whitened"],
            )

    plain = rows.select(*[named(c).alias(f"c{i}") for i, c in enumerate(kept)])
    shape = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(out.fields[:-1])] + [out.fields[-1]])
    return plain.mapInArrow(run, shape).toDF(*out.names)


def op11_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable row of ``embeddings`` on the four first components of the distinct ones.

    A row without vector, or with a null or non-finite entry, is left out. Vectors of
    unequal length are filled up with zeros. Repeated rows and ids come out as often as
    they are there; of equal vectors the fit takes one. Components without variance are
    left out, so one distinct vector, or an empty table, gives no rows. A deviation beyond
    a long fails the job. Other columns of the table are not looked at.
    """
    table = embeddings(spark, sf_dir)
    rows = table.filter(whole(F.col("embedding"))).select("vec_id", scaled(F.col("embedding"), SCALE).alias("x"))
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    staging = Staging(spark)
    fitted = fit(staging.keep(blocks(rows, width), "whitening-blocks"), width, COMPONENTS)
    staging.drop()
    return _long_form(whiten(rows, "x", fitted), fitted)


def _long_form(rows: DataFrame, fitted: Whitening) -> DataFrame:
    sums = F.array(*[F.lit(s).cast("long") for s in fitted.sums]).cast("array<long>")
    apart = F.zip_with(F.col("x"), sums, lambda x, s: F.coalesce(x, F.lit(0)) * F.lit(fitted.n).cast("long") - s)
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda total, a: total + a * a)
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values]).cast("array<double>")
    parts = rows.select("vec_id", deviation.alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
    return parts.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(fitted.identity_error).alias("identity_error"),
    )
