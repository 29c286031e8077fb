"""Session-level helpers: shared scratch space, written intermediates and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# a broadcast side may hold at most this many rows and bytes; both are measured first
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints; a temporary one only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="snapmill-")
    sc.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df by the hash of keys in at least as many partitions as there are cores.

    Adaptive execution keeps a number that is given, while it merges small partitions of any other shuffle: a table
    of many rows but few bytes would be written as one file, and everything fitted on it would run in one task.
    """
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def materialize(df: DataFrame) -> DataFrame:
    """Compute df once into a table in the shared folder and read it back.

    The result has no lineage, survives lost executors, and its readers scan only the columns
    they use. They have no more tasks than the table has files, so what is fitted on again and
    again is spread first.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partition_folder(spark: SparkSession, root: str, keys: dict[str, str]) -> str:
    """The folder of a partition; values are escaped as Spark's writers escape them."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([root.rstrip("/"), *(f"{k}={escape(v)}" for k, v in keys.items())])


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, without Spark's own marker files; none if it is missing."""
    sc = spark.sparkContext
    there = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(there):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(there)]
    return [n for n in names if not n.startswith(("_", "."))]


def folder_stamp(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files below a folder of tables, two levels deep: it changes with them."""
    sc = spark.sparkContext
    there = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(sc._jsc.hadoopConfiguration())
    found = []
    for entry in fs.listStatus(there):
        for f in (fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry]):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list[Row]:
    """Collect fitted parameters; fails rather than pull more than max_rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows of fitted parameters")
    return rows


def written_bytes(df: DataFrame) -> int:
    """Bytes of the files that a written table is read from, as its plan knows them."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a lookup table that has one row per key.

    The lookup is materialised, measured and counted. Up to max_bytes and max_rows it is broadcast, so a key that holds
    much of df never meets a shuffle; beyond that the join shuffles and adaptive execution
    splits the skewed partitions of df.
    """
    lookup = materialize(lookup)
    if written_bytes(lookup) <= max_bytes and lookup.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(lookup), on, how)
    return df.join(lookup.hint("merge"), on, how)
