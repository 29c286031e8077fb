"""Versioned training data: one table partitioned by data id and train indicator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.runtime import partition_folder
from snapmill.sources.commits import GONE, VERSION, CommitLog, new_version

ID, IS_TRAIN = "DATA_ID", "IS_TRAIN"


@dataclass(frozen=True)
class TrainingRegistry:
    """Both sides of a data id are published by one commit marker, so a pair is never half replaced."""

    spark: SparkSession
    path: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path)

    def _folder(self, data_id: str) -> str:
        """The partition folder of an id; its characters are escaped as Spark's writers escape them."""
        return partition_folder(self.spark, "", {ID: data_id}).strip("/")

    def put(self, data_id: str, train: DataFrame, test: DataFrame) -> None:
        """Register a train/test pair, replacing an earlier pair of the same id; without any row the id goes."""
        version = new_version()
        both = (train.withColumn(IS_TRAIN, F.lit(True)).unionByName(test.withColumn(IS_TRAIN, F.lit(False)))
                .withColumns({ID: F.lit(data_id), VERSION: F.lit(version)}))
        # the rebalance splits a large side over several files and merges small ones
        (both.hint("rebalance", F.col(ID), F.col(IS_TRAIN))
         .write.mode("append").partitionBy(ID, VERSION, IS_TRAIN).parquet(self.path))
        written = self.log.written(version)
        self.log.put(self._folder(data_id), version if written else GONE)

    def ids(self) -> DataFrame:
        """Registered ids, from the commit markers alone."""
        unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return self.spark.createDataFrame([(unescape(folder.partition("=")[2]),) for folder in sorted(self.log.current())], f"{ID} string")

    def has(self, data_id: str) -> bool:
        return self.log.state(self._folder(data_id))[1] is not None

    def _read(self, base: str, *folders: str) -> DataFrame:
        # ids are text even when they look like numbers, so their type must not be inferred
        kinds = {ID: T.StringType(), IS_TRAIN: T.BooleanType()}
        found = self.spark.read.options(basePath=base, mergeSchema=True).parquet(*folders).schema
        schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders)

    def all(self) -> DataFrame:
        """The rows of every registered pair, with DATA_ID and IS_TRAIN."""
        root = self.path.rstrip("/")
        folders = [f"{root}/{folder}/{VERSION}={version}" for folder, version in sorted(self.log.current().items())]
        if not folders:
            return self.spark.createDataFrame([], f"{ID} string, {IS_TRAIN} boolean")
        return self._read(root, *folders).drop(VERSION)

    def fetch(self, data_id: str) -> tuple[DataFrame, DataFrame]:
        """(train, test) of an id."""
        _, version = self.log.state(self._folder(data_id))
        if version is None:
            raise ValueError(f"{data_id} is not registered")
        base = f"{self.path.rstrip('/')}/{self._folder(data_id)}/{VERSION}={version}"
        rows = self._read(base, base)
        return rows.where(F.col(IS_TRAIN)).drop(IS_TRAIN), rows.where(~F.col(IS_TRAIN)).drop(IS_TRAIN)

    def remove(self, data_id: str) -> None:
        """Drop an id."""
        if self.has(data_id):
            self.log.put(self._folder(data_id), GONE)

    def vacuum(self) -> int:
        """Delete replaced and removed data; only while nobody writes or reads an older state."""
        return self.log.vacuum()
