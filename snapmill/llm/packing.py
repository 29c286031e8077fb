"""Packing by optimal length buckets.

Documents are cut into pieces of at most `longest` tokens (words). Dynamic programming over the global
histogram of piece lengths chooses the bucket boundaries that minimise padding, and inside each bucket
batches are filled up to a token budget: a batch holds budget // boundary pieces, all padded to the
boundary of the bucket.

The histogram has at most `longest` rows whatever the corpus. Pieces are numbered inside a bucket
without gathering it in one task: all pieces lie in range partitions by bucket and hash, and a piece's
number is its place inside its partition plus the counts of the earlier ones.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill.operators.ranked import running_sums
from snapmill.runtime import collect_bounded, materialize

LONGEST = 2_048
BUCKETS = 12
BUDGET = 16_384


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least padding, ascending.

    lengths are distinct and ascending. cost[k][j] is the least padded size of the first j lengths in k
    buckets; of equal choices the one that ends the last bucket's predecessor first is taken.
    """
    if not len(lengths):
        return []
    n = len(lengths)
    below = np.concatenate(([0], np.cumsum(counts, dtype=np.float64)))
    cost = np.concatenate(([0.0], np.full(n, np.inf)))
    cut = []
    for _ in range(min(buckets, n)):
        best, where = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            padded = cost[:j] + (below[j] - below[:j]) * float(lengths[j - 1])
            where[j] = int(np.argmin(padded))
            best[j] = padded[where[j]]
        cut.append(where)
        cost = np.minimum(best, np.inf)
        cost[0] = np.inf
    # the number of buckets is as given (padding never grows with it)
    out, j = [], n
    for where in reversed(cut):
        out.append(int(lengths[j - 1]))
        j = int(where[j])
    return sorted(out)


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but space and the control characters 9 to 13."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def pack(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, budget: int = BUDGET,
         length: Column | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, n_tokens, bucket_length, batch_id, slot, n_padding.

    A document of n tokens gives ceil(n / longest) pieces, all but the last of full length; a null or
    empty text gives one piece without tokens, in the shortest bucket. Batches are numbered from 0
    through all buckets, shortest first; only the last batch of a bucket may be partly filled. The order
    inside a bucket is by hash of doc_id and piece, ties by doc_id. Rows repeated with the same doc_id
    give pieces each; null doc_ids are kept.
    """
    if budget < longest:
        raise ValueError("a batch must hold the longest piece")
    n = length if length is not None else word_count(F.coalesce(F.col("text").cast("string"), F.lit("")))
    sizes = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.cast("long").alias("n")))
    pieces = (sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / longest) - 1, F.lit(0)).cast("int"))))
              .select("doc_id", "piece", F.least(F.col("n") - F.col("piece").cast("long") * longest, F.lit(longest).cast("long")).alias("n_tokens")))
    histogram = collect_bounded(pieces.groupBy("n_tokens").count().orderBy("n_tokens"), longest + 1, "piece lengths")
    bounds = boundaries(np.array([r["n_tokens"] for r in histogram], np.int64),
                        np.array([r["count"] for r in histogram], np.int64), buckets)
    if not bounds:
        return pieces.select("doc_id", "piece", "n_tokens", F.col("n_tokens").alias("bucket_length"),
                             F.lit(0).cast("long").alias("batch_id"), F.lit(0).cast("long").alias("slot"),
                             F.lit(0).cast("long").alias("n_padding"))
    fill = [budget // max(b, 1) for b in bounds]
    held = [sum(r["count"] for r in histogram if low < r["n_tokens"] <= high) for low, high in zip([-1, *bounds], bounds, strict=False)]
    batches = [-(-h // f) for h, f in zip(held, fill, strict=True)]
    first = np.concatenate(([0], np.cumsum(batches)[:-1])).tolist()

    bucket = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[i], i).otherwise(bucket)
    order = F.struct(F.xxhash64("doc_id", "piece").alias("mark"), "doc_id", "piece", "n_tokens")
    ordered = pieces.withColumns({"bucket": bucket, "order": order, "one": F.lit(1)})
    numbered = running_sums(ordered, ["bucket"], "order", ["one"]).withColumn("at", F.col("CUM_one") - 1)

    def of(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket") + 1)

    return numbered.select(
        "doc_id", "piece", "n_tokens", of(bounds).alias("bucket_length"),
        (of(first) + F.floor(F.col("at") / of(fill))).cast("long").alias("batch_id"),
        F.pmod(F.col("at"), of(fill)).alias("slot"), (of(bounds) - F.col("n_tokens")).alias("n_padding"))
