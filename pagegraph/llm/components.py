"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegraph.session import Staging


def _stars(edges: DataFrame) -> DataFrame:
    """One round: each node links to the least it knows, first the greater neighbours', then its own."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    own = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(own, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionAll(own.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u`` and ``v``: for each node of some edge but the least of its component, that least node.

    Edges are pairs (``u``, ``v``) of one orderable type, in any direction, repeated or
    not. Each round is written, so a lost executor costs a round at most; only its
    number of edges and a sum of hashes come to the driver. Rounds grow with the
    logarithm of the longest chain; hubs are left to the engine's skewed joins.
    """
    spark, before, last = edges.sparkSession, None, Staging(edges.sparkSession)
    stars = last.keep(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        own = Staging(spark)
        stars = own.keep(_stars(stars), "stars")
        told = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        last.drop()
        if tuple(told) == before:
            return stars
        before, last = tuple(told), own
