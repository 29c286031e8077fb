"""The corpus pipeline: quality, near-duplicates, long repeats, benchmark leaks, packing.

Every stage takes the documents that its predecessor kept, written as Parquet and read again, and all but
the last return the columns of documents:

1. quality        documents that the discriminant scores below 0.3 go
2. near_duplicates of each group of texts with similar shingles (five words, Jaccard 0.8) one stays
3. long_repeats   bytes of repeats of at least 100 bytes are cut out of the texts; n_chars follows, and
                  a document of which nothing is left goes
4. decontaminate  documents that hold a benchmark item go
5. packing        pieces of documents in length buckets and batches

Nulls: a null text counts as empty; rows with a null doc_id pass stages 1 to 4 like any other but are
never taken for a copy. Empty tables give empty results. Extra columns of documents are kept until the
last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapmill.llm import decontam, packing, quality, runindex, similar
from snapmill.llm.common import read
from snapmill.runtime import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def stage_long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return runindex.cut_repeats(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", stage_quality), ("near_duplicates", stage_near_duplicates), ("long_repeats", stage_long_repeats),
    ("decontaminate", stage_decontaminate), ("packing", stage_packing),
]

# models, fingerprint components and the optimal partition have no practical SQL; tests compare run()
# with a brute-force version of stages 2 to 5 on the documents that the first stage keeps
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what a stage returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
