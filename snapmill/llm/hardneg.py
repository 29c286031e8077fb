"""Hard negatives for contrastive training, scored exactly by Kronecker-packed products.

Components become integers, floor(scale * x). Candidates are cut into blocks of about BLOCK rows; in a block
the biased (so never negative) components of several candidates lie in separate fields of one wide integer, wide
enough for the whole sum. An anchor multiplies each wide integer once per component and adds up; the fields of
the sum, cut apart and freed of the bias, are the exact inner products. Fields are machine words where a
sum fits into one, Python's integers otherwise, so no score ever overflows.

Two passes. The first meets every anchor with the blocks of its own label and keeps its best positives; the
second meets it with all blocks and keeps, for each positive, the first negatives inside that positive's
window of scores. Blocks belong to one hash bucket of labels, and a bucket has as many blocks as it needs: a
label that holds a third of all rows is just more blocks. Anchors are blocked likewise, GROUP anchor blocks
meet a candidate block in one cell, and a task holds one anchor block and one candidate block at a time.
Every cell gives at most a few rows per anchor and positive, which windows merge. The anchors are a stated
set of queries, so work grows with anchors x rows, as the task has it; the driver holds block counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmill.llm.common import small_batches, whole_batches
from snapmill.runtime import materialize

BLOCK = 2_048
ANCHOR_BLOCK = 512
GROUP = 16
LABEL_BUCKETS = 64
TILE = 64
WIDE_FIELDS = 8
MOST_TASKS = 2_000


class Fields:
    """How biased components are laid into wide integers: bits of a field, fields of an integer."""

    def __init__(self, low: int, high: int, width: int) -> None:
        self.bias = -min(low, 0)
        top = max(high, 0) + self.bias
        self.width = width
        self.bits = max(1, (top * top * max(width, 1)).bit_length())
        # sums stay below 2 ** 55, so that a hundredfold still fits
        self.small = self.bits <= 55
        self.fields = 64 // self.bits if self.small else WIDE_FIELDS
        self.kind = np.uint64 if self.small else object

    def pack(self, q: np.ndarray) -> np.ndarray:
        """width x ceil(rows / fields) wide integers of rows x width components."""
        n = -(-len(q) // self.fields) * self.fields
        biased = np.zeros((n, self.width), self.kind)
        biased[:len(q)] = (q.astype(object) + self.bias if not self.small else q + self.bias).astype(self.kind)
        parts = biased.reshape(-1, self.fields, self.width)
        out = parts[:, 0].copy()
        for j in range(1, self.fields):
            out |= parts[:, j] << self.kind(self.bits * j) if self.small else parts[:, j] * (1 << self.bits * j)
        return np.ascontiguousarray(out.T)

    def scores(self, anchors: np.ndarray, q: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors x rows: one multiplication per anchor component and wide integer."""
        a = anchors.astype(object) + self.bias if not self.small else (anchors + self.bias).astype(np.uint64)
        total = np.zeros((len(a), packed.shape[1]), self.kind)
        for at in range(0, len(a), TILE):
            part = total[at:at + TILE]
            for k in range(self.width):
                part += a[at:at + TILE, k, None] * packed[k]
        mask = (1 << self.bits) - 1
        out = np.zeros((len(a), packed.shape[1], self.fields), np.int64 if self.small else object)
        for j in range(self.fields):
            shifted = total >> (self.kind(self.bits * j) if self.small else self.bits * j)
            out[:, :, j] = shifted & (self.kind(mask) if self.small else mask)
        exact = np.int64 if self.small else object
        sums = anchors.astype(exact).sum(axis=1)[:, None] + q.astype(exact).sum(axis=1)[None, :] + self.width * self.bias
        return out.reshape(len(a), -1)[:, :len(q)] - self.bias * sums


def best_first(scores: np.ndarray, usable: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first n usable columns of each row by falling score, ties by place; rank by rank."""
    none = np.iinfo(np.int64).min if scores.dtype != object else -(1 << 200)
    left = np.where(usable, scores, none)
    rows, columns = [], []
    going = np.arange(len(left))
    for _ in range(min(n, left.shape[1])):
        # the first of equals is the one with the smallest id, as columns ascend by id
        top = left[going].argmax(axis=1)
        some = left[going, top] != none
        going, top = going[some], top[some]
        rows.append(going)
        columns.append(top)
        left[going, top] = none
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *columns])


def _by_bucket(values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("bucket") + 1)


def _blocked(rows: DataFrame, size: int) -> tuple[DataFrame, list[int], list[int]]:
    """rows with a block number, and the first and the number of blocks of each label bucket.

    A block has about `size` rows and belongs to one bucket; a bucket's blocks are numbered in a row.
    """
    counts = {r["bucket"]: r["count"] for r in rows.groupBy("bucket").count().collect()}
    many = [-(-counts.get(b, 0) // size) for b in range(LABEL_BUCKETS)]
    first = [sum(many[:b]) for b in range(LABEL_BUCKETS)]
    inside = F.pmod(F.xxhash64(F.lit("block"), "vec_id", "q"), _by_bucket([max(m, 1) for m in many]))
    return rows.withColumn("block", (_by_bucket(first) + inside).cast("int")), first, many


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, embedding, label. Anchors are the rows whose vec_id is divisible by `every`; an anchor's
    positives are the first `positives` other rows of its label by score, its negatives for a positive the
    first `negatives` rows of other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score. Higher scores come first, ties by smaller vec_id.

    Rows with a null vec_id or label, a null vector or a null or non-finite component take no part. Rows
    that repeat vec_id, label and integer vector count once; other rows with an anchor's vec_id are neither
    its positives nor its negatives. A shorter vector counts as padded with zeros. floor(scale * x) stops at
    the ends of a 64-bit integer; scores beyond them are ranked exactly and returned as null.
    """
    spark = rows.sparkSession
    out_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    x = F.col("embedding").cast("array<double>")
    fit = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
           .where("vec_id is not null and label is not null and x is not null "
                  "and forall(x, v -> coalesce(not isnan(v) and abs(v) < double('infinity'), false))"))
    whole = fit.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * float(scale))).cast("array<long>").alias("q"),
                       F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int").alias("bucket"))
    whole = materialize(whole)
    seen = whole.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("vec_id").alias("ids"), F.max(F.size("q")).alias("width"),
                     F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high")).first()
    if not seen["n"]:
        return spark.createDataFrame([], out_schema)
    if seen["ids"] < seen["n"]:
        whole = materialize(whole.dropDuplicates(["vec_id", "label", "q"]))
    layout = Fields(seen["low"] or 0, seen["high"] or 0, seen["width"])
    kind = np.result_type(np.min_scalar_type(min(seen["low"] or 0, 0)), np.min_scalar_type(max(seen["high"] or 0, 0)))
    kind = np.dtype(np.int64) if kind.kind != "i" else kind
    width = seen["width"]
    # scores travel as longs, or as decimals where a long is too short
    score_type = "long" if layout.small else "decimal(38,0)"

    def pack_rows(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        q = np.zeros((len(part), width), kind)
        for i, v in enumerate(part["q"]):
            q[i, :len(v)] = v
        return pd.DataFrame({"bucket": [int(part["bucket"].iloc[0])], "block": [int(part["block"].iloc[0])],
                             "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                             "labels": [part["label"].to_numpy(np.int64).tobytes()], "q": [q.tobytes()]})

    block_schema = "bucket int, block int, ids binary, labels binary, q binary"
    marked, c_first, c_many = _blocked(whole, block)
    candidates = materialize(marked.groupBy("bucket", "block").applyInPandas(pack_rows, block_schema))
    marked, a_first, a_many = _blocked(whole.where(F.pmod("vec_id", F.lit(every)) == 0), anchor_block)
    anchors = materialize(marked.groupBy("bucket", "block").applyInPandas(pack_rows, block_schema))
    if not sum(a_many):
        return spark.createDataFrame([], out_schema)

    def unpacked(ids: bytes, labels: bytes, q: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(ids, np.int64)
        return ids, np.frombuffer(labels, np.int64), np.frombuffer(q, kind).reshape(len(ids), width).astype(np.int64)

    def sent(values: list | np.ndarray) -> list | np.ndarray:
        if layout.small:
            return values
        from decimal import Decimal

        return [Decimal(int(v)) for v in values]

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        last, packed = None, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, labels, q = unpacked(r.ids, r.labels, r.q)
                if r.block != last:
                    last, packed = r.block, layout.pack(q)
                a_ids, a_labels, a = unpacked(r.a_ids, r.a_labels, r.a_q)
                tiles = []
                for at in range(0, len(a), TILE):
                    here = slice(at, at + TILE)
                    same = a_labels[here, None] == labels[None, :]
                    other = a_ids[here, None] != ids[None, :]
                    tiles.append((here, same, other))
                yield r, ids, a_ids, tiles, lambda here: layout.scores(a[here], q, packed)

    def best_positives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, ids, _, tiles, score in scored(batches):
            out = []
            for here, same, other in tiles:
                usable = same & other
                if usable.any():
                    s = score(here)
                    i, j = best_first(s, usable, positives)
                    out.append((here.start + i, ids[j], s[i, j]))
            if out:
                place, found, got = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"a_block": r.a_block, "place": place.astype(np.int32), "positive_id": found, "positive_score": sent(got)})

    def best_negatives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, ids, a_ids, tiles, score in scored(batches):
            place = np.array([p["place"] for p in r.positives])
            found = np.array([p["positive_id"] for p in r.positives])
            got = np.array([int(p["positive_score"]) for p in r.positives], np.int64 if layout.small else object)
            out = []
            for here, same, other in tiles:
                mine = np.nonzero((place >= here.start) & (place < here.stop))[0]
                usable = ~same & other
                if not len(mine) or not usable.any():
                    continue
                s = score(here)
                row = place[mine] - here.start
                # whole numbers, so the bounds may be rounded inwards
                lines, top, least = s[row], high * got[mine] // 100, -(-low * got[mine] // 100)
                i, j = best_first(lines, usable[row] & (lines <= top[:, None]) & (lines >= least[:, None]), negatives)
                out.append((place[mine[i]], a_ids[place[mine[i]]], found[mine[i]], got[mine[i]], ids[j], lines[i, j]))
            if out:
                at, who, found_, got_, other_, n = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"a_block": r.a_block, "place": at.astype(np.int32), "anchor_id": who, "positive_id": found_,
                                    "positive_score": sent(got_), "negative_id": other_, "negative_score": sent(n)})

    def meet(asked: DataFrame, own: bool) -> DataFrame:
        """Every anchor block beside the candidate blocks of its bucket, or beside all candidate blocks.

        A cell is one candidate block with the anchor blocks of one group; both sides are copied to their cells.
        """
        held = [b for b in range(LABEL_BUCKETS) if a_many[b]]
        last_group = (sum(a_many) - 1) // GROUP
        c_low, c_high = ([0] * LABEL_BUCKETS, [sum(c_many) - 1] * LABEL_BUCKETS)
        g_low, g_high = ([0] * LABEL_BUCKETS, [last_group] * LABEL_BUCKETS)
        if own:
            c_low, c_high = c_first, [f + m - 1 for f, m in zip(c_first, c_many, strict=True)]
            g_low, g_high = [f // GROUP for f in a_first], [(f + m - 1) // GROUP for f, m in zip(a_first, a_many, strict=True)]
        cells = sum(c_many[b] * (g_high[b] - g_low[b] + 1) for b in (held if own else range(LABEL_BUCKETS)))
        tasks = max(1, min(cells, MOST_TASKS))
        a = (asked.withColumnsRenamed({n: f"a_{n}" for n in ("block", "ids", "labels", "q")})
             .withColumn("group", F.floor(F.col("a_block") / GROUP).cast("int"))
             .withColumn("block", F.explode(F.sequence(_by_bucket(c_low), _by_bucket(c_high)))).drop("bucket"))
        c = candidates.where(F.col("bucket").isin(held)) if own else candidates
        c = c.withColumn("group", F.explode(F.sequence(_by_bucket(g_low), _by_bucket(g_high)))).drop("bucket")
        # a stated number of tasks: adaptive execution would merge these small but slow partitions
        return (c.repartition(tasks, "block", "group").join(a.repartition(tasks, "block", "group").hint("merge"), ["block", "group"])
                .drop("group"))

    small_batches(spark, 1)
    place = "a_block int, place int"
    found = meet(anchors, own=True).mapInPandas(best_positives, f"{place}, positive_id long, positive_score {score_type}")
    nth = F.row_number().over(Window.partitionBy("a_block", "place").orderBy(F.desc("positive_score"), "positive_id"))
    pairs = materialize(found.withColumn("nth", nth).where(F.col("nth") <= positives).drop("nth"))
    asked = pairs.groupBy(F.col("a_block").alias("block")).agg(
        F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))
    asking = materialize(anchors.join(asked, "block"))
    hits = meet(asking, own=False).mapInPandas(
        best_negatives, f"{place}, anchor_id long, positive_id long, positive_score {score_type}, negative_id long, negative_score {score_type}")
    hits = materialize(hits)
    whole_batches(spark)
    rank = F.row_number().over(Window.partitionBy("a_block", "place", "positive_id", "positive_score")
                               .orderBy(F.desc("negative_score"), "negative_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.expr("try_cast(positive_score as long)").alias("positive_score"),
        F.expr("try_cast(negative_score as long)").alias("negative_score"))
