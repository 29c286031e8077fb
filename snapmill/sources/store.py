"""Snapshot tables: parquet folders partitioned by the snapshot date, published date by date."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.config import DEFAULT
from snapmill.functions.exprs import dt_lit
from snapmill.runtime import folder_names, lookup_join
from snapmill.sources.commits import GONE, VERSION, CommitLog, new_version


@dataclass(frozen=True)
class SnapshotTable:
    """One snapshot table. schema, when given, spares the read a file-footer inference.

    A write lays its rows beside the visible ones and publishes each date with one commit marker, so readers
    see the old or the new snapshot of a date, never a part. Replaced versions stay until vacuum(). A folder
    that was written without commit markers is read as it stands.
    """

    spark: SparkSession
    path: str
    dt_key: str = DEFAULT.dt_key
    schema: T.StructType | None = None

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path)

    def _partition(self, d: date) -> str:
        return f"{self.dt_key}={d.isoformat()}"

    def _reader(self):
        return self.spark.read.schema(self.schema) if self.schema else self.spark.read

    def _versions(self, versions: dict[str, str]) -> DataFrame:
        """Rows of the given version of each partition folder; filters on the date prune folders."""
        paths = [f"{self.path.rstrip('/')}/{folder}/{VERSION}={v}" for folder, v in sorted(versions.items())]
        if not paths:
            if self.schema is None:
                raise ValueError(f"{self.path} holds no snapshot")
            return self.spark.createDataFrame([], self.schema)
        return self._reader().option("basePath", self.path).parquet(*paths).drop(VERSION)

    def all(self) -> DataFrame:
        if not self.log.used():
            return self._reader().parquet(self.path)
        return self._versions(self.log.current())

    def exists(self) -> bool:
        """True when the table holds a snapshot."""
        return bool(self.log.current()) if self.log.used() else bool(folder_names(self.spark, self.path))

    def read(self, d: date) -> DataFrame:
        """One snapshot; the date predicate prunes to its partition."""
        return self.all().where(F.col(self.dt_key) == dt_lit(d))

    def read_many(self, dates: Iterable[date]) -> DataFrame:
        return self.all().where(F.col(self.dt_key).isin(list(dates)))

    def list_dates(self) -> DataFrame:
        """Dates that have a snapshot. Only the partition column is read."""
        return self.all().select(self.dt_key).distinct()

    def counts(self) -> DataFrame:
        return self.all().groupBy(self.dt_key).agg(F.count(F.lit(1)).alias("N_ROWS"))

    def count(self, d: date) -> int:
        return self.read(d).count()

    def succeeded(self, d: date) -> bool:
        """True when the snapshot has at least one row."""
        if self.log.used():
            return self.log.state(self._partition(d))[1] is not None
        return self.exists() and not self.read(d).isEmpty()

    def stage(self, df: DataFrame, d: date | None = None) -> str:
        """Write rows (those of d, if given) as a new version that no reader sees yet."""
        if not self.log.used():
            if folder_names(self.spark, self.path):
                raise ValueError(f"{self.path} was written without commit markers")
            self.log.begin()
        version = new_version()
        if d is not None:
            df = df.where(F.col(self.dt_key) == dt_lit(d))
        # the rebalance splits a large snapshot over several files and merges small ones
        (df.hint("rebalance", F.col(self.dt_key)).withColumn(VERSION, F.lit(version))
         .write.mode("append").partitionBy(self.dt_key, VERSION).parquet(self.path))
        return version

    def staged(self, version: str) -> DataFrame:
        """The rows of a staged version, for checks before it is published."""
        return self._versions({folder: version for folder in self.log.written(version)})

    def discard(self, version: str) -> None:
        self.log.discard(version)

    def publish(self, version: str, d: date | None = None, replace: bool = True) -> list[str]:
        """Make a staged version visible; the partition folders that it now holds.

        Without replace, dates that are visible already keep their snapshot and of two writers of a date one
        wins. With d and no row for it, an earlier snapshot of d is no longer visible afterwards.
        """
        written = self.log.written(version)
        if replace and d is not None and self._partition(d) not in written:
            self.log.put(self._partition(d), GONE)
        if replace:
            for folder in written:
                self.log.put(folder, version)
            return written
        return [folder for folder in written if self.log.put_if_absent(folder, version)]

    def overwrite(self, df: DataFrame, d: date | None = None) -> None:
        """Replace exactly the partitions present in df (or the one of d), leave the others.

        With d and no row for it, the earlier snapshot of d goes.
        """
        self.publish(self.stage(df, d), d)

    def insert(self, df: DataFrame) -> None:
        """Write the dates of df that have no snapshot yet; existing snapshots stay as they are."""
        if self.exists():
            df = lookup_join(df, self.list_dates(), [self.dt_key], "left_anti")
        self.publish(self.stage(df), replace=False)

    def vacuum(self) -> int:
        """Delete replaced and abandoned versions; only while nobody writes or reads an older state."""
        return self.log.vacuum()


def src_file(spark: SparkSession, path: str, columns: list[str] | None = None, nrows: int | None = None,
             schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet or CSV file by its suffix. A CSV without a schema has its types inferred."""
    if path.endswith("parquet"):
        df = spark.read.parquet(path)
    elif path.endswith("csv"):
        reader = spark.read.option("header", True)
        df = reader.csv(path, schema=schema) if schema else reader.option("inferSchema", True).csv(path)
    else:
        raise TypeError("only .parquet and .csv files can be read")
    if columns:
        df = df.select(*columns)
    return df.limit(nrows) if nrows is not None else df


def src_query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """An SQL query over the catalog and the given views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def preview(df: DataFrame, order_by: list[str] | None = None, n: int = 10) -> DataFrame:
    """The first n rows; ordered, they are the same rows in every run."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def columns(df: DataFrame) -> list[str]:
    return df.columns
