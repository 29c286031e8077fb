"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into three segments of 23, 23 and 18 bits. If two differ in at most
three bits, then two of the segments differ in at most one bit each (pigeonhole), so a pair of segments
is a key that tolerates one error in each. The binary Golay code of length 23 corrects three errors: a
segment decodes to its home codeword, and to the (one or six) codewords within four errors; if two
segments differ in one bit, the home codeword of each is among the others of the other. One side of a
key is therefore (home, near), the other (near, home): about 11 keys for each of the three pairs of
segments instead of the 28 of (near, near).

Keys are shuffled once and their rows compared inside the tasks, by the number of differing bits; a
task hands on a spanning forest of its links and never all pairs. A key with more than `dense`
fingerprints is not compared at all: its fingerprints meet at their common midpoints (x and y within
three bits have a midpoint one bit from x and two from y), a number of rows linear in their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import forget, small_batches, texts, whole_batches
from snapmill.llm.components import components
from snapmill.runtime import materialize

SEED = 42
SHINGLE = 3
ERRORS = 3
DENSE = 16_384
# generator polynomial of the binary Golay code of length 23 (fixed value)
GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The fingerprint of one whole text, unsigned; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        part = np.unpackbits(h[at:at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (as a signed long) of every row of texts(docs)."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp})

    return texts(docs).mapInPandas(made, "doc_id long, fp long")


def _remainder(x: int) -> int:
    for shift in range(11, -1, -1):
        if x >> (shift + 11) & 1:
            x ^= GENERATOR << shift
    return x


class Golay:
    """Decoding of 23-bit words to codeword indices (their upper 12 bits)."""

    def __init__(self) -> None:
        unit = [_remainder(1 << i) for i in range(23)]
        low, high = np.zeros(1 << 12, np.int32), np.zeros(1 << 11, np.int32)
        for i in range(23):
            t, bit = (low, i) if i < 12 else (high, i - 12)
            t[(np.arange(len(t)) >> bit & 1).astype(bool)] ^= unit[i]
        self.low, self.high = low, high
        found: list[list[int]] = [[] for _ in range(1 << 11)]
        for weight in range(5):
            for places in combinations(range(23), weight):
                s = 0
                for i in places:
                    s ^= unit[i]
                found[s].append(sum(1 << i for i in places))
        # the lightest error comes first; cosets with one pattern repeat it
        self.count = np.array([len(f) for f in found])
        self.errors = np.array([(f * 6)[:6] for f in found], np.int64)

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codeword indices within four errors, home first (n x 6), and how many of them are distinct."""
        s = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words[:, None] ^ self.errors[s]) >> 11, self.count[s]


def keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, index of the fingerprint, side (0: home then near, 1: near then home) of all keys."""
    u = fps.view(np.uint64)
    decoded = [code.near((u >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64)) for at, bits in SEGMENTS]
    out = []
    for pair, (a, b) in enumerate(combinations(range(3), 2)):
        for side, (near, home, shift_near, shift_home) in enumerate(((b, a, 0, 12), (a, b, 12, 0))):
            words, count = decoded[near]
            row, column = np.nonzero(np.arange(6)[None, :] < count[:, None])
            key = (pair << 24) | (words[row, column] << shift_near) | (decoded[home][0][row, 0] << shift_home)
            out.append((key, row, np.full(len(row), side, np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each connected component of the links: (member, smallest member)."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def links(left: np.ndarray, right: np.ndarray, errors: int, block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one key that differ in at most `errors` bits, block by block, kept as a forest."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    rows = max(1, block // max(len(right), 1))
    for at in range(0, len(left), rows):
        part = left[at:at + rows]
        i, j = np.nonzero(np.bitwise_count((part[:, None] ^ right[None, :]).view(np.uint64)) <= errors)
        a, b = np.concatenate((a, part[i])), np.concatenate((b, right[j]))
        if len(a) > block:
            a, b = forest(a, b)
    return a, b


def near_links(fps: DataFrame, errors: int = ERRORS, dense: int = DENSE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` within `errors` (at most 3) bits."""
    if errors > 3:
        raise ValueError("the keys hold for at most three differing bits")
    fps = materialize(fps.select("fp").distinct())

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Golay()
        for b in batches:
            if len(b):
                fp = b["fp"].to_numpy(np.int64)
                key, row, side = keys(fp, code)
                yield pd.DataFrame({"key": key.astype(np.int32), "fp": fp[row], "side": side})

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        flooded = None  # a key whose rows go on to the midpoints

        def settle(key: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pd.DataFrame:
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(start, len(key)))
            a, b, lone = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            right = np.add.reduceat(side.astype(np.int64), start)
            for s, n in zip(start[(right > 0) & (right < size)].tolist(), size[(right > 0) & (right < size)].tolist(), strict=True):
                if n > dense:
                    lone.append(fp[s:s + n])
                    continue
                f, d = fp[s:s + n], side[s:s + n] == 1
                if n == 2:
                    if f[0] != f[1] and int(np.bitwise_count((f[:1] ^ f[1:]).view(np.uint64))[0]) <= errors:
                        a.append(f[:1])
                        b.append(f[1:])
                    continue
                x, y = links(f[~d], f[d], errors)
                a.append(x)
                b.append(y)
            a, b = forest(np.concatenate(a), np.concatenate(b))
            alone = np.unique(np.concatenate(lone)) if lone else np.empty(0, np.int64)
            return pd.DataFrame({"a": np.concatenate((a, alone)), "b": pd.array([*b.tolist(), *[None] * len(alone)], "Int64")})

        def crowd(fp: np.ndarray) -> pd.DataFrame:
            alone = np.unique(fp)
            return pd.DataFrame({"a": alone, "b": pd.array([None] * len(alone), "Int64")})

        for batch in batches:
            key, fp, side = (batch[c].to_numpy() for c in ("key", "fp", "side"))
            if not len(key):
                continue
            if flooded is not None:
                same = key == flooded
                if same.any():
                    yield crowd(fp[same])
                key, fp, side = key[~same], fp[~same], side[~same]
                if not len(key):
                    continue
                flooded = None
            held.append((key, fp, side))
            key, fp, side = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if cut:
                yield settle(key[:cut], fp[:cut], side[:cut])
            held = [(key[cut:], fp[cut:], side[cut:])]
            if len(key) - cut > dense:
                flooded = key[-1]
                yield crowd(fp[cut:])
                held = []
        if held:
            yield settle(*(np.concatenate(x) for x in zip(*held, strict=True)))

    whole_batches(fps.sparkSession)
    found = materialize(fps.mapInPandas(keyed, "key int, fp long, side byte").repartition("key")
                        .sortWithinPartitions("key").mapInPandas(compared, "a long, b long"))
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    return found.where("b is not null").distinct().unionByName(_by_midpoint(crowded, errors))


def _by_midpoint(fps: DataFrame, errors: int) -> DataFrame:
    """Links of fingerprints within three bits (or fewer) through the words between them."""
    far = errors - errors // 2
    masks = [sum(1 << i for i in p) for n in range(far + 1) for p in combinations(range(64), n)]
    near = sum(1 for m in masks if m.bit_count() <= errors // 2)
    flips = np.array(masks, np.uint64).view(np.int64)

    def between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for fp in b["fp"].tolist():
                yield pd.DataFrame({"mid": flips ^ np.int64(fp), "fp": fp, "close": np.arange(len(flips)) < near})

    words = fps.mapInPandas(between, "mid long, fp long, close boolean")
    hubs = words.where("close").groupBy("mid").agg(F.min("fp").alias("b"))
    return words.join(hubs, "mid").where("fp != b").select(F.col("fp").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, errors: int = ERRORS, dense: int = DENSE, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row of docs.

    component_id is the smallest doc_id of all rows whose fingerprints are linked, directly or through
    others. Null and empty texts have fingerprint zero and are linked like any other; rows with a null
    doc_id are linked too (component_id is null if no linked row has an id); repeated rows are kept.
    """
    small_batches(docs.sparkSession)
    marked = materialize(fingerprints(docs, shingle))
    roots = components(near_links(marked, errors, dense))
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = (first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(classes.join(least, "root").select("fp", "component_id"))
    forget()
    return marked.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

