"""Spelling variants: bidirectional FM-index search schemes over the delimited vocabulary.

Two words are near if one inserted, deleted or replaced character turns one into the other. Then one half of
the searching word stands unchanged at its end of the near word, and the error lies in the other half. So two
searches find everything: match the right half and the delimiter behind it exactly and extend leftwards
allowing one error, or match the left half and the delimiter before it exactly and extend rightwards. The first
runs on an FM-index of the delimited vocabulary, the second on one of the reversed vocabulary; both halves
begin at a delimiter, so a search keeps to the direction of its index and its interval of suffix ranks is
all it carries. A search ends at the far delimiter, where the rank names the word.

The index is dealt by what an exact half must show: words sharing the first letters of the shortest left half
(or the last letters of the shortest right half) lie in one bucket, so a word asks two buckets only. There are as
many buckets as the vocabulary's characters call for. A bucket beyond SHARD_CHARS is cut into parts by word, each
part with an index of its own, and its questions likewise; all pairs of parts meet in cells of bounded size,
so a letter pair that begins a third of all words is spread. All states of a cell advance together in numpy.

The vocabulary is counted over all documents with partial sums. Roots follow forms by pointer doubling on
distributed tables: a form has at least twice its word's count, so chains are short and free of cycles.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import small_batches, whole_batches
from snapmill.runtime import materialize

# fixed values of the word rule: runs of A-Z, a-z and U+00C0 to U+00FF, as UTF-8 bytes in lower case
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
MODULUS = 97
MIN_CHARS = 5
MIN_COUNT = 3
SHARD_CHARS = 65_536
FLUSH = 200_000


class FMIndex:
    """FM-index over $w1$w2$...$ of distinct words, for backward searches of many states at once.

    Symbols are numbered by code point from 1, the delimiter is 0. Occurrences are kept as the ascending keys
    symbol * (n + 1) + row of the transform, so a binary search over them is the rank and the first row of
    the symbol in one.
    """

    def __init__(self, words: list[str]) -> None:
        text = "\0" + "\0".join(words) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.letters, symbols = np.unique(codes, return_inverse=True)
        symbols = symbols.astype(np.int64)
        n = self.n = len(symbols)
        order = self._suffixes(symbols)
        before = symbols[order - 1]
        self.bwt = before
        self.keys = np.sort(before * (n + 1) + np.arange(n))
        self.sigma = len(self.letters)
        # suffixes that begin with a delimiter come first; each names the word behind it
        starts = np.nonzero(symbols == 0)[0]
        self.words = np.searchsorted(starts, order[:len(starts)])

    @staticmethod
    def _suffixes(symbols: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling."""
        n, step = len(symbols), 1
        rank = symbols.copy()
        while True:
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            both = rank * (n + 2) + after
            order = np.argsort(both, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(np.diff(both[order]) != 0)))
            rank = new
            if rank[order[-1]] == n - 1:
                return order
            step *= 2

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in one array and where each begins; a letter the index lacks is -1."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, codes), self.sigma - 1)
        symbols = np.where(self.letters[at] == codes, at, -1)
        return symbols, np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + match; empty ones have low >= high."""
        base = symbol * (self.n + 1)
        found = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        return np.where(symbol < 0, 0, found[0]), np.where(symbol < 0, 0, found[1])

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol) of every letter that stands before some match of a state."""
        wide = high - low > self.sigma
        states, symbols = [], []
        few = np.nonzero(~wide)[0]
        size = (high - low)[few]
        row = np.repeat(low[few] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        pair = np.unique(np.repeat(few, size) * self.sigma + self.bwt[row])
        pair = pair[pair % self.sigma > 0]
        states.append(pair // self.sigma)
        symbols.append(pair % self.sigma)
        many = np.nonzero(wide)[0]
        states.append(np.repeat(many, self.sigma - 1))
        symbols.append(np.tile(np.arange(1, self.sigma), len(many)))
        return np.concatenate(states), np.concatenate(symbols)

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of words at one error from a query, with its last `exact` letters unchanged at the end."""
        symbols, starts = self.encode(queries)
        n = len(queries)
        q = np.arange(n)
        left = np.diff(starts)                      # letters not matched yet
        low, high = np.zeros(n, np.int64), np.full(n, len(self.words), np.int64)
        low, high = self.extend(np.zeros(n, np.int64), low * 0, high * 0 + self.n)
        # the exact half, letter by letter
        todo = exact.astype(np.int64).copy()
        while (going := todo > 0).any():
            c = symbols[starts[q[going]] + left[going] - 1]
            low[going], high[going] = self.extend(c, low[going], high[going])
            left[going] -= 1
            todo[going] -= 1
            alive = low < high
            q, left, low, high, todo = q[alive], left[alive], low[alive], high[alive], todo[alive]
        # clean states wait at `left` letters; states with the error used only go on exactly
        hit_q, hit_w = [], []
        wq, wl, wlow, whigh = (np.zeros(0, np.int64) for _ in range(4))
        while len(q) or len(wq):
            # finished: the error is used and all letters are matched; the delimiter must stand before
            end = wl == 0
            if end.any():
                a, b = self.extend(np.zeros(int(end.sum()), np.int64), wlow[end], whigh[end])
                ok = a < b
                size = (b - a)[ok]
                row = np.repeat(a[ok] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                hit_q.append(np.repeat(wq[end][ok], size))
                hit_w.append(self.words[row])
                wq, wl, wlow, whigh = wq[~end], wl[~end], wlow[~end], whigh[~end]
            if len(wq):
                wlow, whigh = self.extend(symbols[starts[wq] + wl - 1], wlow, whigh)
                alive = wlow < whigh
                wq, wl, wlow, whigh = wq[alive], wl[alive] - 1, wlow[alive], whigh[alive]
            if not len(q):
                continue
            state, c = self.branches(low, high)
            a, b = self.extend(c, low[state], high[state])
            more = left[state] > 0
            own = np.where(more, symbols[starts[q[state]] + np.maximum(left[state], 1) - 1], -1)
            swap = more & (own != c)
            drop = left > 0
            wq = np.concatenate((wq, q[state], q[state][swap], q[drop]))
            wl = np.concatenate((wl, left[state], left[state][swap] - 1, left[drop] - 1))
            wlow = np.concatenate((wlow, a, a[swap], low[drop]))
            whigh = np.concatenate((whigh, b, b[swap], high[drop]))
            # the clean states take their own letter
            q, left, low, high = q[drop], left[drop], low[drop], high[drop]
            if len(q):
                low, high = self.extend(symbols[starts[q] + left - 1], low, high)
                alive = low < high
                q, left, low, high = q[alive], left[alive] - 1, low[alive], high[alive]
        if not hit_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = np.unique(np.concatenate(hit_q) * len(self.words) + np.concatenate(hit_w))
        return pair // len(self.words), pair % len(self.words)


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, modulus: int = MODULUS) -> DataFrame:
    """word, n: the words of whole texts that have at least min_chars letters and min_count occurrences.

    A run of a document whose crc32 of `<doc_id>:<run>` is divisible by modulus loses one letter first.
    """
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True):
                runs: dict[bytes, int] = {}
                for r in RUN.findall(text.encode("utf-8", "surrogatepass").lower()):
                    runs[r] = runs.get(r, 0) + 1
                start = zlib.crc32(f"{doc_id}:".encode())
                for r, n in runs.items():
                    h = zlib.crc32(r, start)
                    if h % modulus == 0:
                        w = r.decode()
                        at = h % len(w)
                        r = (w[:at] + w[at + 1:]).encode()
                    held[r] = held.get(r, 0) + n
            if len(held) >= FLUSH:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    def table(held: dict[bytes, int]) -> pd.DataFrame:
        return pd.DataFrame([(w, n) for k, n in held.items() if len(w := k.decode()) >= min_chars], columns=["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.where("text is not null").mapInPandas(words, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def near_pairs(vocabulary: DataFrame, min_chars: int = MIN_CHARS, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """word, near: all ordered pairs of distinct words at exactly one error; every word has at least min_chars letters."""
    head, tail = min_chars // 2, min_chars - min_chars // 2
    if head < 1:
        raise ValueError("both halves of the shortest word must have a letter")
    length = F.char_length("word")
    both = vocabulary.select("word", length.alias("size"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, head).alias("ends")),
        F.struct(F.lit(1).alias("side"), F.expr(f"right(word, {tail})").alias("ends")))).alias("s")).select("word", "size", "s.side", "s.ends")
    total = vocabulary.agg(F.coalesce(F.sum(length + 1), F.lit(0)).alias("chars")).first()["chars"]
    buckets = max(1, -(-total // shard_chars))
    keyed = both.withColumn("bucket", F.pmod(F.xxhash64("ends"), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("side", "bucket").agg(F.ceil(F.sum(F.col("size") + 1) / shard_chars).cast("int").alias("parts"))
    # as many rows as buckets, counted by the join itself
    placed = materialize(keyed.join(materialize(sizes).hint("merge"), ["side", "bucket"])
                         .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    indexed = placed.select("side", "bucket", F.col("part").alias("held"), every.alias("asked"), "word")
    asking = placed.select("side", "bucket", every.alias("held"), F.col("part").alias("asked"), "word")

    def search(key: tuple, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({"word": [], "near": []})
        words, queries = held["word"].tolist(), asked["word"].tolist()
        sizes = np.array([len(w) for w in queries])
        flip = key[0] == 0
        index = FMIndex([w[::-1] for w in words] if flip else words)
        q, w = index.near([x[::-1] for x in queries] if flip else queries, sizes // 2 if flip else sizes - sizes // 2)
        return pd.DataFrame({"word": asked["word"].to_numpy(object)[q], "near": held["word"].to_numpy(object)[w]})

    cell = ["side", "bucket", "held", "asked"]
    found = indexed.groupBy(*cell).cogroup(asking.groupBy(*cell)).applyInPandas(search, "word string, near string")
    # an error at the middle is found from both sides
    return found.distinct()


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, modulus: int = MODULUS, ratio: int = 2,
             shard_chars: int = SHARD_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary.

    form is the near word of largest n, ties by code points, if its n is at least ratio times the word's;
    root follows forms to the last. Null texts hold no words; a null doc_id counts as the empty text in
    the deletion rule; repeated rows count each; an empty table gives an empty result; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    spark = docs.sparkSession
    small_batches(spark)
    words = materialize(count_words(docs, min_chars, min_count, modulus))
    whole_batches(spark)
    pairs = near_pairs(words.select("word"), min_chars, shard_chars)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # of (count negated, word) the least: strings order by their UTF-8 bytes, hence by code points
    best = (pairs.join(counts, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    forms = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n")))

    # pointer doubling: words without a form are their own root and leave the rounds
    steps = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        steps = materialize(steps)
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = materialize(steps.join(onward, "root", "left"))
        if joined.where("beyond is not null").isEmpty():
            break
        steps = joined.select("word", F.coalesce("beyond", "root").alias("root"))
    return forms.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
