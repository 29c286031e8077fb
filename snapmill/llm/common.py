"""What the training-data operators share: reading their inputs, hold-out folds, model rows."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.runtime import BROADCAST_ROWS, materialize

# rows of one Arrow batch: texts may be long, and a batch is held by a Python worker as a whole
BATCH_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of Python workers: whole texts come in batches of few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def whole_batches(spark: SparkSession) -> None:
    """The usual batches again, for narrow rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns that the operators use, under fixed names; a null text is empty."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id, text and label (0/1) of at most max_rows labelled documents outside the held-out fold.

    Labels repeated for a key count once, by their mean rounded down; null labels are left out. Beyond
    max_rows the rows with the smallest hash of their key are taken. The bound makes the labels small
    enough to broadcast, so texts are never shuffled to meet them.
    """
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), modulus) != held))
             .groupBy("doc_id").agg(F.floor(F.avg("label")).cast("int").alias("label"))
             .orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(max_rows))
    return texts(docs).join(F.broadcast(marks), "doc_id").select("doc_id", "text", "label")


def forget() -> None:
    """Let Spark remove shuffle files that no plan refers to any more.

    They are otherwise kept until the driver happens to collect its garbage, although the tables
    written from them have replaced them.
    """
    gc.collect()
    session = SparkSession.getActiveSession()
    if session is not None:
        session._jvm.System.gc()


def few_rows(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small enough to broadcast."""
    return df.limit(max_rows + 1).count() <= max_rows


def without(docs: DataFrame, ids: DataFrame, max_rows: int = BROADCAST_ROWS, distinct_ids: bool = True) -> DataFrame:
    """The rows of docs whose doc_id is not among ids; with distinct_ids one row for each non-null doc_id.

    The ids are counted: up to max_rows they are broadcast, beyond that both sides are shuffled by
    doc_id. Repeated ids are looked for on the ids alone, and only if there are any the texts meet.
    """
    ids = materialize(ids)
    few = few_rows(ids, max_rows)
    left = docs.join(F.broadcast(ids) if few else ids.hint("merge"), "doc_id", "left_anti").select(*docs.columns)
    if not distinct_ids:
        return left
    counts = docs.agg(F.count("doc_id").alias("rows"), F.countDistinct("doc_id").alias("distinct")).first()
    if counts["rows"] == counts["distinct"]:
        return left
    named = left.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(left.where("doc_id is null"))
