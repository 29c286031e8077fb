"""Landed snapshot files into a RAW table, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapmill.sources.schemas import partition_columns, schema_conform


def feed_raw(spark: SparkSession, landing: str, source_schema: T.StructType, declared: T.StructType, path: str,
             checkpoint: str, max_files: int = 1000) -> StreamingQuery:
    """Append the files that arrived below landing since the last run, conformed to the declared schema.

    The file sink's log and the checkpoint make every file appear exactly once, also when a run
    is interrupted; the run ends when nothing new is left. Read the table by its path.
    """
    files = spark.readStream.schema(source_schema).option("maxFilesPerTrigger", max_files).parquet(landing)
    rows: DataFrame = schema_conform(files, declared)
    return (rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy(*partition_columns(declared)).trigger(availableNow=True).start())
