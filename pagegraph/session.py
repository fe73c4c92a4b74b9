"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings worth having on a cluster; every one is a default a user can override.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Pages cost far more time than bytes: let small tables use every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # Pages and long texts cost time by the byte: smaller splits spread them further.
    "spark.sql.files.maxPartitionBytes": "32m",
    # One Arrow batch of pages is bounded by bytes, whatever the page size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
    # A frontier too large to broadcast still prunes pages before their shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512m",
    # Page budgets up to this size are cut on the map side, before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
PARQUET_CODEC = "spark.sql.parquet.compression.codec"


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Put the recommended settings on a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def staging_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    ``spark.checkpoint.dir``, which a cluster must point at shared storage; where
    it is not set, a folder of the session's warehouse, which all executors reach
    as well. Never a machine-local temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staging"
    return configured.rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path in the staging folder, removed when the application ends."""
    path = f"{staging_dir(spark)}/pagegraph/{label}-{uuid.uuid4().hex}"
    fs, hadoop_path = _hadoop(spark, path)
    fs.deleteOnExit(hadoop_path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


@contextmanager
def _with_setting(spark: SparkSession, key: str, value: str, default: str):
    before = spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """Shuffle files of the writes inside go as soon as each write has ended."""
    return _with_setting(spark, FILE_CLEANUP, "true", "false")


def _buckets_unsorted(spark: SparkSession):
    """Rows of the bucketed writes inside go to the file of their bucket as they come.

    Spark sorts them by bucket otherwise, bodies included, though here a task has one bucket only.
    """
    return _with_setting(spark, OPEN_WRITERS, "2", "0")


def staged(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives the
    planner the true size of the table: it broadcasts the table while that size
    is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond.
    With ``partition_by`` the rows of each value lie in a folder of their own.
    Inside ``passing`` it goes when that block ends, else with the application.
    """
    block = _PASSING.get()
    if block is not None:
        return block.keep(df, label, partition_by)
    return _written(df, staging_path(df.sparkSession, label), partition_by)


def _written(df: DataFrame, path: str, partition_by: str | None) -> DataFrame:
    spark = df.sparkSession
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(
    df: DataFrame, label: str, by: list[str], buckets: int | None = None, path: str | None = None, name: str | None = None
) -> DataFrame:
    """``df`` written once as a table bucketed by some columns, in the shared folder.

    Joins and groupings by just these columns leave the table where it is: only the
    other side is shuffled, into as many parts. ``buckets`` is the number of shuffle
    partitions unless given; a table to be joined by others needs about one a core and
    some 200 MB at most. Its entry in the session's catalog, ``name``, is an external table:
    a catalog that outlives the session keeps the entry until it is dropped. Inside
    ``passing`` a table without a path of its own goes when that block ends.
    """
    block = _PASSING.get()
    if block is not None and path is None:
        return block.bucketed(df, label, by, buckets)
    spark = df.sparkSession
    path = path or staging_path(spark, label)
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"pagegraph_{uuid.uuid4().hex}"
    with shuffles_removed(spark), _buckets_unsorted(spark):
        df.repartition(count, *by).write.bucketBy(count, *by).option("path", path).saveAsTable(name)
    return spark.table(name)


class Staging:
    """Staged tables of one job, removed together once nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def bucketed(self, df: DataFrame, label: str, by: list[str], buckets: int | None = None) -> DataFrame:
        self.paths.append(staging_path(self.spark, label))
        self.tables.append(f"pagegraph_{uuid.uuid4().hex}")
        return bucketed(df, label, by, buckets, self.paths[-1], self.tables[-1])

    def keep(self, df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
        self.paths.append(staging_path(self.spark, label))
        return _written(df, self.paths[-1], partition_by)

    def drop(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths, self.tables = [], []


_PASSING: ContextVar[Staging | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession):
    """What is ``staged`` or ``bucketed`` inside is removed when the block ends, also when it fails.

    For steps whose result is written before that: nothing may read their tables later.
    The block's ``keep`` writes a table that an inner block leaves for it. Tables written
    inside are compressed with zstd, as several lie side by side.
    """
    block = Staging(spark)
    before = _PASSING.set(block)
    try:
        with _with_setting(spark, PARQUET_CODEC, "zstd", "snappy"):
            yield block
    finally:
        _PASSING.reset(before)
        block.drop()
