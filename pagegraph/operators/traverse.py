"""Bounded breadth-first search for many seeds at once.

A node's place in the queue is one number, ``bfs_key``: 0 for the seed, then the
link positions on the way to it, each a digit to the base 2^63, so that any BIGINT
position has room and three levels fit DECIMAL(38, 0). Keys of one seed sort in queue
order, a deeper level always after a shallower one, so ``min(bfs_key)`` over
everything reached so far is at once the first-parent rule and the test for nodes
already queued, in one hash aggregate that combines before its shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagegraph.session import staged

# The depths a traversal may have.
MIN_DEPTH = 1
MAX_DEPTH = 3

KEY = "decimal(38,0)"
BASE = 1 << 63


def clamp_depth(depth: int) -> int:
    return min(max(depth, MIN_DEPTH), MAX_DEPTH)


def first_key(level: int) -> int:
    """Smallest key of a level."""
    return sum(BASE**k for k in range(level))


def key_literal(value: int) -> Column:
    return F.lit(str(value)).cast(KEY)


def child_key(parent_key: Column, position: Column) -> Column:
    """Key of the child at a zero-based position; a negative one fails the job."""
    message = F.concat(F.lit("negative link position: "), position.cast("string"))
    place = F.when(position < 0, F.raise_error(message).cast("bigint")).otherwise(position.cast("bigint"))
    return (parent_key * key_literal(BASE) + place.cast(KEY) + F.lit(1)).cast(KEY)


def next_frontier(
    queued: DataFrame, candidates: DataFrame, level: int, max_nodes: int | None
) -> DataFrame:
    """Nodes of ``level`` not queued before, each at its earliest place.

    ``queued`` and ``candidates`` hold ``seed, node, bfs_key``. With a budget only
    the first ``max_nodes`` of a seed's queue are kept; a sorted limit on the map
    side bounds what a seed sends to that ranking.
    """
    reached = (
        queued.unionByName(candidates).groupBy("seed", "node").agg(F.min("bfs_key").alias("bfs_key"))
    )
    if max_nodes is not None:
        queue = Window.partitionBy("seed").orderBy("bfs_key")
        reached = reached.withColumn("place", F.row_number().over(queue))
        reached = reached.filter(F.col("place") <= max_nodes).drop("place")
    return reached.filter(F.col("bfs_key") >= key_literal(first_key(level)))


def seed_frontier(seeds: DataFrame) -> DataFrame:
    return seeds.select("seed", F.col("seed").alias("node"), key_literal(0).alias("bfs_key"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def bfs(
    edges: DataFrame, seeds: DataFrame, depth: int = MIN_DEPTH, max_nodes: int | None = None
) -> DataFrame:
    """Nodes within ``depth`` levels of each seed: ``seed, node, level, bfs_key``.

    ``edges`` holds ``src, pos, dst`` with ``pos >= 0``; ``seeds`` holds ``seed``.
    Each frontier is staged, so the next join knows its size: a small one is
    broadcast to the edges, a large one joined by shuffle, where AQE splits the
    edges of a hub.
    """
    if max_nodes is not None and max_nodes < 1:
        return _levels([seed_frontier(seeds.select("seed")).limit(0)])
    frontiers = [seed_frontier(seeds.select("seed").distinct())]
    for level in range(1, clamp_depth(depth)):
        reached = frontiers[-1].join(edges, F.col("node") == F.col("src"))
        candidates = reached.select(
            "seed", F.col("dst").alias("node"), child_key(F.col("bfs_key"), F.col("pos")).alias("bfs_key")
        )
        frontier = staged(next_frontier(union_all(frontiers), candidates, level, max_nodes), f"frontier{level}")
        if frontier.isEmpty():
            break
        frontiers.append(frontier)
    return _levels(frontiers)


def _levels(frontiers: list[DataFrame]) -> DataFrame:
    return union_all([f.withColumn("level", F.lit(i)) for i, f in enumerate(frontiers)])
