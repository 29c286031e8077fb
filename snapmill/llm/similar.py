"""Near-duplicates by similarity of word shingles, found with wide SimHash fingerprints and Golay keys.

A document's distinct shingles give a fingerprint of eleven segments of 23 bits. Two documents whose
shingle sets have a Jaccard similarity of 0.8 differ in about 15 percent of the bits, so some segments
differ in very few; a segment's key is its home codeword on one side, the codewords within four errors
on the other (see simhash.Golay), together with the size class of the set (sets of similarity s differ
in size by the factor 1/s at most). Keys are shuffled once; within a key fingerprints are compared by
all their bits, and those near enough are joined by the spanning forest of smallest distances, so a group
of any size hands on fewer links than it has members. Every link is then verified by the exact Jaccard
similarity of the two shingle sets.

Fingerprints miss some links at just the similarity. So what they leave apart is joined exactly: two sets
of similarity s share one of their first n - ceil(s n) + 1 shingles in any common order (rest_links). The
order puts shingles that many documents hold last, and only texts of different components are paired, once
for each run of shingles that follow each other in both. Positions and parity bits bound the similarity from
above, so most pairs never leave the task. Forests of the likeliest links go first, with at most one link for
each component in a key; what they join is one component in the passes that follow, and the last pass takes
every pair still apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.llm.common import few_rows, forget, small_batches, texts, whole_batches, without
from snapmill.llm.components import components
from snapmill.llm.simhash import SEED, Golay
from snapmill.runtime import materialize

SEGMENTS = 11
BITS = 23 * SEGMENTS
WORDS = 4
SHINGLE = 5
SIMILARITY = 0.8
# links handed to the exact check: two standard deviations beyond the bits expected at the similarity
SLACK = 2.0


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, none without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist(), strict=True)], np.uint64))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """BITS majority bits over the hashes, in WORDS 64-bit words."""
    ones = np.zeros((WORDS, 64), np.int64)
    for at in range(0, len(hashes), 4096):
        for k in range(WORDS):
            h = (hashes[at:at + 4096] + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
            ones[k] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).ravel()
    bits[BITS:] = False
    return np.packbits(bits, bitorder="little").view("<u8")


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether 256 classes of the hashes are odd, in WORDS 64-bit words: two sets differ in at least as many members as bits."""
    odd = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<u8")


def allowed(similarity: float) -> int:
    """Bits in which sets of this similarity may differ and still be checked."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(BITS * p + SLACK * math.sqrt(BITS * p * (1 - p)))


def segment_keys(words: np.ndarray, size_class: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, row, side of every key: side 0 the home codeword in two size classes, side 1 the near ones in one."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")[:, :BITS]
    out = []
    for s in range(SEGMENTS):
        value = bits[:, 23 * s:23 * s + 23].astype(np.int64) @ (1 << np.arange(23))
        near, count = code.near(value)
        base = np.int64(s) << 24
        row, column = np.nonzero(np.arange(6)[None, :] < count[:, None])
        out.append((base | size_class[row] << 12 | near[row, column], row, np.ones(len(row), np.int8)))
        every = np.arange(len(value))
        for more in (0, 1):
            out.append((base | (size_class + more) << 12 | near[:, 0], every, np.zeros(len(every), np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def forest(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Positions of the links (a, b) in the spanning forest of smallest distances; ties by the nodes' order."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    order = np.lexsort((np.maximum(x, y), np.minimum(x, y), d))
    x, y = x[order], y[order]
    label = np.arange(len(nodes))
    taken = np.zeros(len(x), bool)
    while True:
        open_ = np.flatnonzero(label[x] != label[y])
        if not len(open_):
            break
        best = np.full(len(nodes), len(x))
        np.minimum.at(best, label[x[open_]], open_)
        np.minimum.at(best, label[y[open_]], open_)
        chosen = np.unique(best[best < len(x)])
        taken[chosen] = True
        while True:  # components of the chosen links
            low = np.minimum(label[x[chosen]], label[y[chosen]])
            new = label.copy()
            np.minimum.at(new, label[x[chosen]], low)
            np.minimum.at(new, label[y[chosen]], low)
            new = new[label]
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
    return order[taken]


def spanning(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of the spanning forest of smallest distances."""
    keep = forest(a, b, d)
    return a[keep], b[keep], d[keep]


def compare(left: np.ndarray, right: np.ndarray, most: int, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of left and right within `most` bits and their distance, block by block, as a spanning forest."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, block // max(len(right), 1))
    for at in range(0, len(left), step):
        part = left[at:at + step]
        d = np.zeros((len(part), len(right)), np.int64)
        for k in range(WORDS):
            d += np.bitwise_count(part[:, k, None] ^ right[None, :, k])
        i, j = np.nonzero(d <= most)
        if len(i):
            parts.append((i + at, j + len(left), d[i, j]))
            if sum(len(p[0]) for p in parts) > 2 * block:
                parts = [spanning(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
    if not parts:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def node_of(words: np.ndarray) -> np.ndarray:
    """A 64-bit name of each wide fingerprint."""
    name = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        name = (name ^ (name >> np.uint64(29)) ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
    return (name ^ (name >> np.uint64(32))).view(np.int64)


_COLUMNS = [f"w{k}" for k in range(WORDS)]
_PARITIES = [f"p{k}" for k in range(WORDS)]


# the order of shingles is read from about so many documents; it changes the work, never the links
ORDER_DOCS = 20_000
ORDER_SEEN = 4
ORDER_SHINGLES = 1_000_000


def common_shingles(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Shingles that many documents hold, rarest first, as a sample shows them; at most ORDER_SHINGLES, the most frequent."""
    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"h": np.concatenate([shingles(t, size) for t in b["text"]]).view(np.int64)})

    every = max(1, docs.count() // ORDER_DOCS)
    some = texts(docs).where(F.pmod(F.xxhash64(F.lit("order"), "doc_id"), F.lit(every)) == 0)
    seen = some.mapInPandas(hashes, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= ORDER_SEEN)
    rows = seen.orderBy(F.desc("n"), "h").limit(ORDER_SHINGLES).toPandas()
    return rows["h"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def prefix(hashes: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first n - ceil(similarity n) + 1 shingles: by hash those not in common (sorted), then common ones by rank."""
    n = len(hashes)
    take = n - math.ceil(similarity * n - 1e-9) + 1 if n else 0
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        order = np.where(common[at] == hashes, rank[at], -1)
        hashes = hashes[np.argsort(order, kind="stable")]
    return hashes[:take]


def fingerprints(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node, w0..w3, p0..p3, n (distinct shingles) and the first shingles in the common order of every row."""
    ranked = common_shingles(docs, size)
    by_hash = np.argsort(ranked)
    order = docs.sparkSession.sparkContext.broadcast((ranked[by_hash], by_hash))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                sets = [shingles(t, size) for t in b["text"]]
                words = np.array([wide_fingerprint(s) for s in sets], np.uint64)
                odd = np.array([parities(s) for s in sets], np.uint64)
                yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "node": node_of(words),
                                    **dict(zip(_COLUMNS, words.view(np.int64).T, strict=True)),
                                    **dict(zip(_PARITIES, odd.view(np.int64).T, strict=True)), "n": [len(s) for s in sets],
                                    "first": [prefix(s, *order.value, similarity).view(np.int64) for s in sets]})

    return texts(docs).mapInPandas(made, "doc_id long, node long, w0 long, w1 long, w2 long, w3 long, "
                                         "p0 long, p1 long, p2 long, p3 long, n int, first array<long>")


def near_sizes(n: np.ndarray, root: np.ndarray, similarity: float, most: int = 1 << 20,
               key: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of different roots, of one key (0, 1, ..; None: all), whose sizes allow the similarity, about `most` pairs a piece."""
    key = np.zeros(len(n), np.int64) if key is None else key
    order = np.lexsort((n, key))
    sizes, roots, base = n[order].astype(np.int64), root[order], key[order] << 32
    # partners of a row are behind it, up to the size that the similarity allows
    end = np.searchsorted(base + sizes, base + np.floor(sizes / similarity + 1e-6).astype(np.int64), side="right")
    width = end - np.arange(len(n)) - 1
    cut = np.flatnonzero(np.diff(np.cumsum(width) // most, prepend=-1))
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(n)], strict=True):
        i = np.repeat(np.arange(lo, hi), width[lo:hi])
        first = np.repeat(np.cumsum(width[lo:hi]) - width[lo:hi], width[lo:hi])
        j = i + 1 + np.arange(len(i)) - first
        apart = roots[i] != roots[j]
        yield order[i[apart]], order[j[apart]]


# rounds of forests before the pass over all pairs still apart
FORESTS = 1


def shared_firsts(nodes: DataFrame) -> DataFrame:
    """key, node, n, p0..p3, at, before of the first shingles that nodes of several roots hold.

    nodes has one row (node, root, n, first, p0..p3) per node. A key is a shingle, `at` its position in the
    node's order and `before` the shingle in front of it.
    """
    rows = nodes.select("node", "root", "first", F.posexplode("first").alias("at", "key")).select(
        "key", "node", "root", "at", F.when(F.col("at") > 0, F.get("first", F.col("at") - 1)).otherwise(0).alias("before"))
    every = Window.partitionBy("key")
    mixed = (rows.withColumns({"low": F.min("root").over(every), "high": F.max("root").over(every)})
             .where("low != high").drop("low", "high", "root"))
    return materialize(mixed.join(nodes.select("node", "n", *_PARITIES), "node"))


def reaching(links: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The links (a, b) that may reach the similarity by their first shingles (node, n, first): all others lie behind the shorter reach."""
    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = []
            for x, y, m, n in zip(b["x"], b["y"], b["na"], b["nb"], strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True)) + max(m - len(x), n - len(y))
                keep.append(common >= math.ceil(similarity / (1 + similarity) * (m + n) - 1e-9))
            yield b.loc[keep, ["a", "b"]]

    links = materialize(links)
    small_batches(links.sparkSession, 1000)
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("first").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("first").alias("y"))
    return materialize(links.join(left, "a").join(right, "b").select("a", "b", "x", "y", "na", "nb").mapInPandas(bounded, "a long, b long"))


def rest_links(shared: DataFrame, known: DataFrame, similarity: float = SIMILARITY, whole: bool = True) -> DataFrame:
    """Links (a, b) between nodes of different roots that may reach the similarity; with `whole` none that does is left out.

    shared are shared_firsts, known has (node, root) of every node. At the first key that two sets share, all
    they have in common lies at or behind it, and the shingles in front of it differ; sets differ in at least
    as many shingles as parity bits. Without `whole` only a forest over the roots of the likeliest links is made.
    """
    whole_batches(shared.sparkSession)

    def settle(key: np.ndarray, node: np.ndarray, root: np.ndarray, n: np.ndarray, at: np.ndarray, before: np.ndarray,
               *odd: np.ndarray) -> Iterator[pd.DataFrame]:
        if not len(key):
            return
        number = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))).astype(np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def named(i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])}).drop_duplicates()

        def likeliest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            i, j, d = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep = forest(root[i], root[j], d)
            return i[keep], j[keep], d[keep]

        for i, j in near_sizes(n, root, similarity, key=number):
            total = n[i] + n[j]
            needed = np.ceil(similarity / (1 + similarity) * total - 1e-9)
            fits = (np.minimum(n[i] - at[i], n[j] - at[j]) >= needed) & ((at[i] == 0) | (at[j] == 0) | (before[i] != before[j]))
            i, j, total, needed = i[fits], j[fits], total[fits], needed[fits]
            # unsigned, since of a negative number the absolute value would be counted
            d = sum(np.bitwise_count((p[i] ^ p[j]).view(np.uint64)).astype(np.int64) for p in odd)
            fits = d <= total - 2 * needed
            i, j, d = i[fits], j[fits], d[fits] / total[fits]
            if whole and len(i):
                yield named(i, j)
            elif len(i):
                parts.append((i, j, d))
                if sum(len(p[0]) for p in parts) > 1 << 18:
                    parts = [likeliest()]
        if parts:
            yield named(*likeliest()[:2])

    columns = ["key", "node", "root", "n", "at", "before", *_PARITIES]

    def paired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(tuple(batch[c].to_numpy(np.int64) for c in columns))
            if held[0][0][0] == held[-1][0][-1]:
                continue  # one key goes on
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(parts[0], parts[0][-1]))
            yield from settle(*(x[:cut] for x in parts))
            held = [tuple(x[cut:] for x in parts)]
        if held:
            yield from settle(*(np.concatenate(x) for x in zip(*held, strict=True)))

    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = shared.join(known, "node").select(*columns).repartition(parts, "key").sortWithinPartitions("key")
    return rows.mapInPandas(paired, "a long, b long").distinct()


def candidates(fps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints are near enough to be verified."""
    most, ratio = allowed(similarity), -math.log(similarity)
    whole_batches(fps.sparkSession)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Golay()
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at:at + 500]
                words = part[_COLUMNS].to_numpy(np.int64)
                size_class = np.floor(np.log(np.maximum(part["n"].to_numpy(), 1)) / ratio + 1e-9).astype(np.int64)
                key, row, side = segment_keys(words.view(np.uint64), size_class, code)
                yield pd.DataFrame({"key": key.astype(np.int32), "side": side, **dict(zip(_COLUMNS, words[row].T, strict=True))})

    def settle(key: np.ndarray, side: np.ndarray, words: np.ndarray) -> pd.DataFrame:
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(start, len(key)))
        right = np.add.reduceat(side.astype(np.int64), start)
        both = (right > 0) & (right < size) & (size > 1)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, n in zip(start[both].tolist(), size[both].tolist(), strict=True):
            w, near = words[s:s + n], side[s:s + n] == 1
            w = np.concatenate((w[~near], w[near]))
            i, j, d = compare(w[:n - near.sum()], w[n - near.sum():], most)
            if len(i):
                name = node_of(w)
                other = name[i] != name[j]
                x, y, _ = spanning(name[i[other]], name[j[other]], d[other])
                a.append(np.minimum(x, y))
                b.append(np.maximum(x, y))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append((batch["key"].to_numpy(), batch["side"].to_numpy(), batch[_COLUMNS].to_numpy(np.int64).view(np.uint64)))
            if held[0][0][0] == held[-1][0][-1]:
                continue  # one key goes on
            key, side, words = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1]))
            yield settle(key[:cut], side[:cut], words[:cut])
            held = [(key[cut:], side[cut:], words[cut:])]
        if held:
            yield settle(*(np.concatenate(x) for x in zip(*held, strict=True)))

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = fps.select(*_COLUMNS, "n").dropDuplicates(_COLUMNS).repartition(parts)
    return materialize(distinct.mapInPandas(keyed, "key int, side byte, w0 long, w1 long, w2 long, w3 long").repartition("key")
                       .sortWithinPartitions("key").mapInPandas(compared, "a long, b long")).distinct()


def verified(links: DataFrame, docs: DataFrame, marked: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """The links whose two shingle sets have at least the Jaccard similarity."""
    links = materialize(links)
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # one document stands for a node
    chosen = materialize(marked.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(nodes, "node"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [shingles(t, size).tobytes() for t in b["text"]]
            yield pd.DataFrame({"node": b["node"], "shingles": found})

    small_batches(docs.sparkSession)
    named = F.broadcast(chosen) if few_rows(chosen) else chosen
    held = materialize(texts(docs).join(named, "doc_id").select("node", "text").mapInPandas(sets, "node long, shingles binary")
                       .groupBy("node").agg(F.any_value("shingles").alias("shingles")))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = []
            for x, y in zip(b["x"], b["y"], strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(common >= similarity * (len(p) + len(q) - common))
            yield b.loc[keep, ["a", "b"]]

    left = held.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = held.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return materialize(links.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(exact, "a long, b long"))


def merged(known: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after the links (a, b) between nodes have joined their roots."""
    bridges = (links.join(known.toDF("a", "x"), "a").join(known.toDF("b", "y"), "b")
               .select(F.col("x").alias("a"), F.col("y").alias("b")))
    joined = components(bridges).toDF("root", "whole")
    return materialize(known.join(joined, "root", "left").select("node", F.coalesce("whole", "root").alias("root")))


def groups(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """doc_id, group_id of every row of docs: the smallest doc_id of its near-duplicates, itself included.

    Texts with equal fingerprints are one node; nodes are linked if their shingle sets have at least the
    similarity, directly or through others. Texts without words are one group. Rows with a null doc_id have
    a null group unless a row with an id has the same fingerprint; repeated rows are kept.
    """
    small_batches(docs.sparkSession)
    marked = materialize(fingerprints(docs, size, similarity))
    links = verified(candidates(marked, similarity), docs, marked, similarity, size)
    roots = components(links)
    # the document that verified() takes for a node
    chosen = marked.where("doc_id is not null").groupBy("node").agg(F.min_by(F.struct("n", "first", *_PARITIES), "doc_id").alias("x"))
    nodes = materialize(chosen.select("node", "x.*").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    shared, known = shared_firsts(nodes), nodes.select("node", "root")
    forget()

    def linked(whole: bool) -> DataFrame:
        links = reaching(rest_links(shared, known, similarity, whole), nodes, similarity)
        forget()
        return verified(links, docs, marked, similarity, size)

    for _ in range(FORESTS):
        found = linked(False)
        if found.isEmpty():
            break
        known = merged(known, found)
    known = merged(known, linked(True))
    first = marked.groupBy("node").agg(F.min("doc_id").alias("first"))
    classes = first.join(known, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = classes.groupBy("root").agg(F.min("first").alias("group_id"))
    classes = materialize(classes.join(least, "root").select("node", "group_id"))
    forget()
    return marked.join(classes, "node").select("doc_id", "group_id")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """The rows of docs, all columns, less those with a near-duplicate of a smaller doc_id.

    Of rows repeated with the same doc_id one stays; rows with a null doc_id all stay.
    """
    marked = groups(docs, similarity, size)
    return without(docs, marked.where("group_id < doc_id").select("doc_id").distinct())
