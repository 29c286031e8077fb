"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram is a feature by presence. Its log-count ratio r compares how often labelled toxic and clean
texts contain it; a feature's value is r, and a regularised logistic regression learns the weights of
these scaled features. Features are hashed to BUCKETS; those with the strongest evidence are kept.

Training uses at most MAX_ROWS labelled rows, those with the smallest hash of their key, so a corpus of
any size fits the same bounded sample. Scoring is one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from snapmill.llm.common import fold, labelled, small_batches, texts
from snapmill.runtime import materialize

BUCKETS = 1 << 20
SIZES = (3, 4, 5, 6)
MAX_ROWS = 12_000
MAX_FEATURES = 6_000
MIN_ROWS = 3
SMOOTHING = 1.0


def grams(text: str) -> np.ndarray:
    """Buckets of the distinct character n-grams of the lower-cased whole text, spaces at both ends."""
    codes = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    found = []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(codes) < n:
            break
        h = h[:len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
        if n in SIZES:
            found.append(((h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(44)).astype(np.int64))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def distinct(buckets: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """The distinct values, without sorting: a value counts where its own stamp was left last."""
    order = np.arange(len(buckets), dtype=stamp.dtype)
    stamp[buckets] = order
    return buckets[stamp[buckets] == order]


class Model:
    """Feature buckets, their weights (already times the log-count ratio) and the intercept."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, intercept: float) -> None:
        self.table = np.zeros(BUCKETS, np.float32)
        self.table[buckets] = weights
        self.used = self.table != 0
        self.intercept = float(intercept)
        self.stamp = np.zeros(BUCKETS, np.int32)

    def score(self, text: str) -> float:
        found = grams(text)
        found = np.unique(found[self.used[found]])
        z = self.intercept + float(self.table[found].astype(np.float64).sum())
        return float(1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0))))


def ratios(rows: DataFrame, max_features: int, min_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets with the strongest evidence and their log-count ratios."""
    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, BUCKETS), np.int32)
        stamp = np.zeros(BUCKETS, np.int32)
        for b in batches:
            for text, label in zip(b["text"], b["label"], strict=True):
                seen[label, distinct(grams(text), stamp)] += 1
        for part in np.array_split(np.flatnonzero(seen.any(axis=0)), 16):
            yield pd.DataFrame({"bucket": part, "clean": seen[0, part], "toxic": seen[1, part]})

    total = rows.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in total}
    table = (rows.mapInPandas(counts, "bucket int, clean int, toxic int")
             .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .where(F.col("clean") + F.col("toxic") >= min_rows))
    n0, n1 = n.get(0, 0), n.get(1, 0)
    # log of the smoothed shares, and how many standard errors it lies from zero
    p = (F.col("toxic") + SMOOTHING) / (n1 + 2 * SMOOTHING)
    q = (F.col("clean") + SMOOTHING) / (n0 + 2 * SMOOTHING)
    error = F.sqrt(1 / (F.col("toxic") + SMOOTHING) + 1 / (F.col("clean") + SMOOTHING))
    table = table.select("bucket", F.log(p / q).alias("r"), (F.abs(F.log(p / q)) / error).alias("z"))
    best = table.orderBy(F.desc("z"), "bucket").limit(max_features).collect()
    return np.array([r.bucket for r in best], np.int64), np.array([r.r for r in best], np.float64)


def fit(rows: DataFrame, max_features: int = MAX_FEATURES, min_rows: int = MIN_ROWS,
        regularisation: float = 0.002) -> Model | None:
    """Fit on a bounded table of doc_id, text and label (0/1); None unless both classes occur."""
    small_batches(rows.sparkSession)
    sample = materialize(rows.repartition("doc_id"))
    if sample.select("label").distinct().count() < 2:
        return None
    buckets, r = ratios(sample, max_features, min_rows)
    if not len(buckets):
        return None
    order = np.argsort(buckets)
    buckets, r = buckets[order], r[order]
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [np.unique(at[at >= 0]) for at in (place[grams(t)] for t in b["text"])]
            yield pd.DataFrame({"label": b["label"].astype(float), "at": found})

    size, value = len(buckets), r.tolist()
    schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    rows = sample.select("text", "label").mapInPandas(present, "label double, at array<int>").rdd
    vectors = materialize(sample.sparkSession.createDataFrame(
        rows.map(lambda x: (x["label"], SparseVector(size, x["at"], [value[i] for i in x["at"]]))), schema))
    lr = LogisticRegression(maxIter=60, regParam=regularisation, standardization=False).fit(vectors)
    return Model(buckets, lr.coefficients.toArray() * r, lr.intercept)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, modulus: int = 5, held: int = 0,
             max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) of every row of docs.

    Null texts are scored as empty ones, a null doc_id is kept, repeated rows are scored each; labels
    teach only outside the held-out fold. Without labelled rows of both classes every score is 0.
    """
    model = fit(labelled(docs, labels, "toxic", max_rows, modulus, held))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"],
                                "score": [model.score(t) if model else 0.0 for t in b["text"]]})

    rows = texts(docs).withColumn("held_out", fold(F.col("doc_id"), modulus) == held)
    return (rows.mapInPandas(scored, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
