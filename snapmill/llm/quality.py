"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text becomes DIMENSIONS statistics (lengths, shares of character kinds, word variety, repeated
lines), transformed so that they are roughly normal within a class. A class is a normal density whose
covariance is shrunk towards the pooled one and the diagonal; the score is the logistic of the
difference of the two Mahalanobis log densities, computed with Cholesky factors that are made once.

Training is one distributed sum of outer products over at most MAX_ROWS labelled rows (DIMENSIONS^2
numbers per class reach the driver); scoring is one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import fold, labelled, small_batches, texts

DIMENSIONS = 14
# labelled rows that a fit reads at most
MAX_ROWS = 30_000
# kinds of bytes, fixed: other, lower, upper, digit, space, newline, sentence mark, symbol
_KIND = np.zeros(256, np.int64)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[[9, 11, 12, 13, 32]] = 4
_KIND[10] = 5
_KIND[[ord(c) for c in ".,;:'\"-?()"]] = 6
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 7


def logit(share: float, weight: float) -> float:
    """Log odds of a share seen over `weight` items, smoothed by half an item."""
    hits = share * weight
    return float(np.log((hits + 0.5) / (max(weight - hits, 0.0) + 0.5)))


def statistics(text: str) -> np.ndarray:
    """The transformed statistics of one whole text; an empty text has finite ones too."""
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, w, ln = len(raw), len(words), len(lines)
    lengths = np.fromiter(map(len, words), np.float64, w) if w else np.zeros(1)
    cased = kinds[1] + kinds[2]
    mean = lengths.mean()
    return np.array([
        np.log1p(w),
        np.log1p(mean),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        logit(kinds[2] / max(cased, 1), min(cased, 400)),
        logit(kinds[3] / max(n, 1), min(n, 400)),
        logit(kinds[6] / max(n, 1), min(n, 400)),
        logit(kinds[7] / max(n, 1), min(n, 400)),
        logit((n - kinds[1:].sum()) / max(n, 1), min(n, 400)),
        np.log1p(n / max(ln, 1)),
        np.log1p(len(set(words))) / np.log1p(max(w, 1)),
        logit(1 - len(set(lines)) / max(ln, 1), min(ln, 50)),
        logit(len(set(words)) / max(w, 1), min(w, 400)),
        logit(float((lengths <= 3).mean()), min(w, 400)),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors, half log determinants and log priors of classes 0 and 1."""

    means: np.ndarray
    whitening: np.ndarray
    half_log_det: np.ndarray
    log_prior: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        logs = [self.log_prior[k] - self.half_log_det[k]
                - 0.5 * np.square((x - self.means[k]) @ self.whitening[k].T).sum(axis=1) for k in (0, 1)]
        return 1.0 / (1.0 + np.exp(-np.clip(logs[1] - logs[0], -40.0, 40.0)))


def moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per label the sums of products of (1, statistics), over all rows: one matrix each."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, DIMENSIONS + 1, DIMENSIONS + 1))
        for b in batches:
            for text, label in zip(b["text"], b["label"], strict=True):
                x = np.concatenate(([1.0], statistics(text)))
                total[label] += np.outer(x, x)
        k, i, j = np.indices(total.shape).reshape(3, -1)
        yield pd.DataFrame({"k": k, "i": i, "j": j, "v": total.ravel()})

    out = np.zeros((2, DIMENSIONS + 1, DIMENSIONS + 1))
    for r in rows.mapInPandas(sums, "k int, i int, j int, v double").groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.k, r.i, r.j] = r.v
    return {k: out[k] for k in (0, 1)}


def fit(rows: DataFrame, shrink_pooled: float = 0.1, shrink_diagonal: float = 0.05) -> Discriminant | None:
    """Fit on rows of text and label (0/1); None if a class has fewer than two rows.

    A class covariance is (1 - shrink_pooled) of its own and shrink_pooled of the pooled one; of that,
    shrink_diagonal is replaced by its diagonal.
    """
    small_batches(rows.sparkSession)
    m = moments(rows)
    counts = np.array([m[k][0, 0] for k in (0, 1)])
    if counts.min() < 2:
        return None
    means = np.array([m[k][0, 1:] / counts[k] for k in (0, 1)])
    scatter = np.array([m[k][1:, 1:] / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)])
    pooled = (scatter * counts[:, None, None]).sum(axis=0) / counts.sum()
    white, half = [], []
    for k in (0, 1):
        c = (1 - shrink_pooled) * scatter[k] + shrink_pooled * pooled
        d = np.diag(c) + 1e-4
        c = (1 - shrink_diagonal) * c + shrink_diagonal * np.diag(d) + 1e-4 * np.eye(len(d))
        low = np.linalg.cholesky(c)
        white.append(np.linalg.inv(low))
        half.append(np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(white), np.array(half), np.log(counts / counts.sum()))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 5, held: int = 0,
            max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) of every row of docs.

    Null texts are scored as empty ones, a null doc_id is kept, repeated rows are scored each; labels
    teach only outside the held-out fold. Without labelled rows of both classes every score is 0.5.
    """
    model = fit(labelled(docs, labels, "quality", max_rows, modulus, held))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.array([statistics(t) for t in b["text"]])
                yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"],
                                    "score": model.score(x) if model else np.full(len(b), 0.5)})

    rows = texts(docs).withColumn("held_out", fold(F.col("doc_id"), modulus) == held)
    return (rows.mapInPandas(scored, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least the threshold."""
    model = fit(labelled(docs, labels, "quality", MAX_ROWS))

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.array([statistics(t or "") for t in b["text"]])
                yield b[model.score(x) >= threshold] if model else b

    return docs.mapInPandas(kept, docs.schema)
