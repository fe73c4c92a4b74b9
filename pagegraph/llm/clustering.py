"""Lloyd's clustering with the dimensions dealt out.

Rows lie in chunks, each cut into blocks of some columns. A round sends a block the
slice of the centroids in its columns; it answers with its part of the squared distances,
exact integers, which are added up by chunk and give each row its nearest centroid. The
labels of a chunk then go to its blocks, where each shard of columns adds up its own
part of the new centroids. Blocks are written once, bucketed by chunk and shard, and stay
where they are: a round moves distances and labels, and what the driver sees of
it are the centroids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegraph.llm.vectors import embeddings, packed, runs, scaled, stacked, unpacked, whole
from pagegraph.session import Staging

#: Fixed by the contract of op12.
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
DIMENSIONS = 64
SEED = 3

#: Columns of one shard.
SHARD_WIDTH = 32
#: Entries up to this size keep every squared distance within a long.
LARGEST = 1 << 27

_BLOCK = "chunk long, shard int, ids array<long>, data binary, item int"


def chunked(rows: DataFrame, width: int) -> DataFrame:
    """Rows ``id, x`` (longs, ``width`` of them) as blocks: ``chunk, shard, ids, data, item``.

    A chunk is a run of rows of one task, numbered by the task; the ids go with its first shard.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in runs(batches):
            ids, x = batch.column(0), stacked(batch.column(1), width)
            if x.size and max(-int(x.min()), int(x.max())) > LARGEST:
                raise ValueError(f"an entry beyond {LARGEST}: its squared distance may not fit a long")
            blocks = [packed(x[:, at : at + SHARD_WIDTH]) for at in range(0, width, SHARD_WIDTH)]
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": [chunk] * len(blocks),
                    "shard": pa.array(range(len(blocks)), pa.int32()),
                    "ids": pa.array([ids.to_pylist()] + [None] * (len(blocks) - 1), pa.list_(pa.int64())),
                    "data": [data for data, _ in blocks],
                    "item": pa.array([item for _, item in blocks], pa.int32()),
                }
            )
            chunk += 1

    return rows.mapInArrow(cut, _BLOCK)


def _width_of(shard: int, width: int) -> int:
    return min(SHARD_WIDTH, width - shard * SHARD_WIDTH)


def partial_distances(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``chunk`` and of each of its blocks the rows' squared distances to each slice, packed: ``parts, item``."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for shard, data, item in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                x = unpacked(data, item, _width_of(shard, width)).astype(np.int64)
                slices = centroids[:, shard * SHARD_WIDTH :][:, :SHARD_WIDTH]
                found.append(packed(np.stack([((x - c) ** 2).sum(1) for c in slices], 1)))
            parts, items = pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int32())
            yield pa.RecordBatch.from_pydict({"chunk": batch.column(0), "parts": parts, "item": items})

    return blocks.select("chunk", "shard", "data", "item").mapInArrow(run, "chunk long, parts binary, item int")


def nearest(parts: DataFrame, k: int) -> DataFrame:
    """Parts added up by chunk: ``chunk``, ``labels`` (4 bytes a row) and ``distances`` (8 bytes a row).

    Of centroids equally near the first is taken.
    """

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for part, item in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                total = total + unpacked(part, item, k).astype(np.int64)
        labels = total.argmin(1)
        least = total[np.arange(len(total)), labels]
        yield pa.RecordBatch.from_pydict(
            {"chunk": [key[0].as_py()], "labels": [labels.astype(np.int32).tobytes()], "distances": [least.tobytes()]}
        )

    return parts.groupBy("chunk").applyInArrow(add, "chunk long, labels binary, distances binary")


def slice_sums(blocks: DataFrame, labels: DataFrame, width: int, k: int) -> DataFrame:
    """Of each centroid and dimension the rows' count ``n`` and exact ``total``."""
    shards = -(-width // SHARD_WIDTH)
    told = labels.select("chunk", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "labels")
    met = blocks.select("chunk", "shard", "data", "item").join(told, ["chunk", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, data, item, marks in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                x = unpacked(data, item, _width_of(shard, width)).astype(np.int64)
                mine, own = np.frombuffer(marks, np.int32), totals.setdefault(shard, np.zeros((k, x.shape[1] + 1), np.int64))
                for c in range(k):
                    chosen = x[mine == c]
                    own[c, 0] += len(chosen)
                    own[c, 1:] += chosen.sum(0)
        for shard, own in totals.items():
            c, d = np.meshgrid(np.arange(k), np.arange(own.shape[1] - 1), indexing="ij")
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array(c.ravel(), pa.int32()),
                    "dimension": pa.array(d.ravel() + shard * SHARD_WIDTH, pa.int32()),
                    "n": np.repeat(own[:, 0], own.shape[1] - 1),
                    "total": own[:, 1:].ravel(),
                }
            )

    sums = met.mapInArrow(run, "cluster int, dimension int, n long, total long")
    return sums.groupBy("cluster", "dimension").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def lloyd(blocks: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after so many rounds; a round that changes none is the last, as all further ones would."""
    k, width = centroids.shape
    for _ in range(rounds):
        labels = nearest(partial_distances(blocks, centroids), k)
        moved = centroids.copy()
        for cluster, dimension, n, total in slice_sums(blocks, labels, width, k).collect():
            if n:
                moved[cluster, dimension] = int(total) // n
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def assignments(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of every row."""
    labels = nearest(partial_distances(blocks, centroids), len(centroids))
    ids = blocks.filter("shard = 0").select("chunk", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": one.column(1).flatten(),
                        "cluster": np.frombuffer(one.column(2)[0].as_py(), np.int32),
                        "distance": np.frombuffer(one.column(3)[0].as_py(), np.int64),
                    }
                )

    return ids.join(labels, "chunk").mapInArrow(run, "id long, cluster int, distance long")


def start(rows: DataFrame, seed: int, k: int) -> np.ndarray:
    """The ``k`` rows (``id, x``) whose id has the least hash, null ids last; ties by the vector."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "x").limit(k)
    return np.array([r.x for r in first.select("x").collect()], np.int64)


def op12_lloyd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector of ``embeddings`` with its cluster of eight after ten rounds.

    Usable are vectors of 64 finite entries; others are left out. Repeated rows and ids
    count as often as they are there. With fewer than eight usable vectors there are as
    many clusters; an empty table gives no rows. Entries whose squared distances might
    not fit a long fail the job. Other columns of the table are not looked at.
    """
    vector = F.col("embedding")
    usable = embeddings(spark, sf_dir).filter((F.size(vector) == DIMENSIONS) & whole(vector))
    rows = usable.select(F.col("vec_id").alias("id"), scaled(vector, SCALE).alias("x"))
    staging = Staging(spark)
    centroids = start(rows, SEED, CENTROIDS)
    if not len(centroids):
        return spark.createDataFrame([], _RESULT)
    blocks = staging.bucketed(chunked(rows, DIMENSIONS), "lloyd-blocks", ["chunk", "shard"])
    centroids = lloyd(blocks, centroids, ROUNDS)
    told = Staging(spark).keep(assignments(blocks, centroids), "lloyd-assigned")
    staging.drop()
    inertia = {r.cluster: int(r.inertia) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    by_cluster = lambda values: F.get(F.array(*values), F.col("cluster"))
    return told.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        by_cluster([F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))]).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        by_cluster([F.sha2(F.lit(",".join(map(str, c))), 256) for c in centroids.tolist()]).alias("centroid_sha256"),
    )


_RESULT = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()),
        T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()),
        T.StructField("centroid_sha256", T.StringType()),
    ]
)


def _op12_sql() -> str:
    """The same as plain SQL, a pair of steps a round."""
    square = "CAST(list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [
        f"""vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
)""",
        f"""centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), q) - 1 AS k, q AS c FROM vectors
  ORDER BY sha256('{SEED}:' || vec_id), q LIMIT {CENTROIDS}
)""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""nearest_{r} AS MATERIALIZED (
  SELECT row_id, min({square} * {CENTROIDS} + k) AS code FROM vectors CROSS JOIN centroids_{r} GROUP BY row_id
)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""centroids_{r + 1} AS MATERIALIZED (
  SELECT old.k, coalesce(new.c, old.c) AS c
  FROM centroids_{r} old
  LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (
      SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT code % {CENTROIDS} AS k, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM nearest_{r} JOIN vectors USING (row_id))
      GROUP BY k, i
    )
    GROUP BY k
  ) new ON new.k = old.k
)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(code // {CENTROIDS} AS BIGINT) AS distance,
  CAST(sum(code // {CENTROIDS}) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(code // {CENTROIDS}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM nearest_{ROUNDS} JOIN vectors USING (row_id) JOIN centroids_{ROUNDS} ON k = code % {CENTROIDS}"""
    )


OP12_SQL = _op12_sql()
