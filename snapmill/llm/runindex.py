"""Exact removal of long repeats by run-length indexes.

Every byte covered by a string of `length` bytes that also starts earlier in the corpus is removed.

1. Anchors. In every window of `length` bytes the gram of GRAM bytes with the smallest hash (leftmost on
   ties) is an anchor, chosen by content alone, so equal windows have equal anchors at equal places. Only
   anchors that occur twice can lie in a repeat. One shuffle by anchor finds them; occurrences whose whole
   surroundings (all windows that hold the anchor) are equal to an earlier one's are settled there.
2. Indexes. The surroundings of the other repeated anchors, each text once, meet by anchor and are
   indexed together: suffixes are sorted, the Burrows-Wheeler transform is run-compressed, runs are cut
   where two neighbouring suffixes differ within `length` bytes, and each run keeps its head, the head's
   image under the last-to-first mapping and the smallest corpus position of its suffixes. Streaming the
   texts backwards through the runs gives, position by position, whether the match with the index
   reaches `length` bytes and where it starts first; positions with an earlier start are marked.
3. Marks are grouped by document, merged, and cut out.

All work is spread by anchor or by document. An anchor with very many different surroundings is salted:
each salt has its own index, and the first starts that the indexes found meet in one aggregation. Anchors
so frequent that a sample of documents shows it are spread by their surroundings in the first shuffle
already; that changes where rows go, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import forget, small_batches
from snapmill.runtime import collect_bounded, materialize

LENGTH = 100
GRAM = 32
# anchors held by a task before it hands them on, and bytes of surroundings likewise
HELD_ANCHORS = 150_000
HELD_BYTES = 3 << 20
INDEX_BYTES = 1 << 19
SALT_ROWS = 16_384
# anchors are called frequent by one document in SAMPLED; at most so many
SAMPLED, FREQUENT = 256, 20_000

_FIELDS = (("anchor", "<u8"), ("seg", "<u8"), ("doc", "<i8"), ("sub", "<i8"), ("start", "<i8"), ("size", "<u2"))


def pack(**columns: np.ndarray) -> bytes:
    """Columns of equal length, one after another."""
    return b"".join(np.ascontiguousarray(columns[n], t).tobytes() for n, t in _FIELDS if n in columns)


def unpack(blob: bytes, *names: str) -> dict[str, np.ndarray]:
    kinds = [(n, np.dtype(t)) for n, t in _FIELDS if n in names]
    rows, out, at = len(blob) // sum(t.itemsize for _, t in kinds), {}, 0
    for n, t in kinds:
        out[n] = np.frombuffer(blob, t, rows, at)
        at += rows * t.itemsize
    return out


def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def anchors(raw: bytes, length: int, gram: int, block: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of one text, ascending."""
    places, hashes = [], []
    width = length - gram + 1
    for at in range(0, max(len(raw) - length + 1, 0), block):
        part = raw[at:at + block + length - 1]
        m = len(part) - gram + 1
        words = np.ascontiguousarray(np.ndarray((len(part) - 7,), "<u8", buffer=part, strides=(1,)))
        h = np.zeros(m, np.uint64)
        for o in [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
            h ^= h >> np.uint64(31)
            h += words[o:o + m]
            h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        # the smallest (hash, place) of each window; places take the low 20 bits
        low = (h & ~np.uint64(0xFFFFF)) | np.arange(m, dtype=np.uint64)
        step = 1
        while step * 2 <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[:step - width], low[width - step:])
        p = (low & np.uint64(0xFFFFF)).astype(np.int64)
        p = p[np.concatenate(([True], p[1:] != p[:-1]))]
        places.append(p + at)
        hashes.append(h[p])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    p, first = np.unique(np.concatenate(places), return_index=True)
    return p, np.concatenate(hashes)[first]


def surroundings(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, hash of the surroundings, their start and size, of every anchor of one text."""
    p, h = anchors(raw, length, gram)
    start = np.maximum(p - (length - gram), 0)
    size = np.minimum(p + length, len(raw)) - start
    digest = xxhash.xxh3_64_intdigest
    seg = np.array([digest(raw[s:s + n]) for s, n in zip(start.tolist(), size.tolist(), strict=True)], np.uint64)
    return h, seg, start, size


def sort_suffixes(text: np.ndarray, rest: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffix order of concatenated texts, and classes of positions with equal first `depth` bytes.

    rest is how many bytes follow up to the end of the own text, 0 at its terminator; terminators are
    distinct, ordered by place. Ranks are refined by doubling, only where they are not settled.
    """
    n = len(text)
    key = np.zeros(n, np.int64)
    for j in range(7):
        b = np.zeros(n, np.int64)
        b[:n - j] = text[j:]
        key = (key << 9) | np.where(rest > j, b + 1, 0)
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth, classes, class_depth = 7, rank.copy(), 7
    longest = int(rest.max(initial=0))
    while depth <= longest:
        size = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero((size[rank] > 1) & (rest > depth))
        if not len(open_):
            if depth * 2 <= length:  # settled already: the classes are those of any greater depth
                depth *= 2
                class_depth = depth
                continue
            break
        # positions that end within depth are equal up to their terminators and come first
        ended = np.bincount(rank[(size[rank] > 1) & (rest <= depth)], minlength=n)
        k = rank[open_] * (n + 1) + rank[open_ + depth]
        o = np.argsort(k, kind="stable")
        at, k = open_[o], k[o]
        group = k // (n + 1)
        place = np.arange(len(k))
        first = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), place, 0))
        same = np.maximum.accumulate(np.where(np.concatenate(([True], k[1:] != k[:-1])), place, 0))
        rank[at] = group + ended[group] + same - first
        depth *= 2
        if depth <= length:
            classes, class_depth = rank.copy(), depth
    return np.argsort(rank, kind="stable"), classes, class_depth


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of many short texts.

    heads: first row of each run; images: its image under the last-to-first mapping; least: for each run
    the smallest corpus position among all suffixes that share its first `length` bytes (a sample per run).
    """

    def __init__(self, texts: list[bytes], position: np.ndarray, length: int) -> None:
        """position: corpus position of the first byte of each text; bytes within a text follow on."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes - 1
        text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        n = len(text)
        rest = np.repeat(ends - 1, sizes + 1) - np.arange(n)
        corpus = np.repeat(position - starts, sizes + 1) + np.arange(n)
        order, classes, depth = sort_suffixes(text, rest, length)
        before = np.where(rest[order - 1] > 0, text[order - 1].astype(np.int16), -1)  # -1: a terminator comes before
        shift = np.minimum(order + length - depth, n - 1)
        long_ = rest[order] >= length
        a, b = classes[order], classes[shift]
        same = np.concatenate(([False], (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & long_[1:] & long_[:-1]))
        self.heads = np.flatnonzero(~same | np.concatenate(([True], before[1:] != before[:-1])))
        run = np.diff(np.append(self.heads, n))
        by_byte = np.argsort(before[self.heads], kind="stable")
        self.images = np.empty(len(run), np.int64)
        self.images[by_byte] = np.concatenate(([0], np.cumsum(run[by_byte])[:-1]))
        sample = np.minimum.reduceat(corpus[order], self.heads)
        group = np.flatnonzero(~same[self.heads])
        self.least = np.repeat(np.minimum.reduceat(sample, group), np.diff(np.append(group, len(sample))))
        self.terminators = np.empty(len(texts), np.int64)
        ended = np.flatnonzero(rest[order] == 0)
        self.terminators[np.searchsorted(ends - 1, order[ended])] = ended
        self.sizes, self.length = sizes, length

    def stream(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Step by step backwards: texts, offsets in them, and the first corpus position of the match.

        Only offsets with `length` bytes left are given: there the match with the index is that long.
        """
        texts = np.argsort(-self.sizes, kind="stable")
        alive = len(texts) - np.searchsorted(np.sort(self.sizes), np.arange(int(self.sizes.max(initial=0))), side="right")
        row = self.terminators[texts]
        run = np.searchsorted(self.heads, row, side="right") - 1
        for step, n in enumerate(alive.tolist()):
            row = self.images[run[:n]] + row[:n] - self.heads[run[:n]]
            run = np.searchsorted(self.heads, row, side="right") - 1
            if step + 1 >= self.length:
                yield texts[:n], self.sizes[texts[:n]] - step - 1, self.least[run]


def repeats(texts: list[bytes], position: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, offset and whether an equal string starts earlier, of every string of `length` bytes."""
    found = list(RunIndex(texts, position, length).stream())
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    t, o, least = (np.concatenate(x) for x in zip(*found, strict=True))
    return t, o, least < position[t] + o


def spans(text: np.ndarray, offset: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked offsets as (text, start, end) of the bytes that they cover."""
    o = np.lexsort((offset, text))
    text, offset = text[o], offset[o]
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (offset[1:] != offset[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1
    return text[first], offset[first], offset[last] + length


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, sub, text: places in the corpus order. Null ids come last; sub tells texts of one id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    c = rows.agg(F.count("doc_id").alias("ids"), F.countDistinct("doc_id").alias("distinct"), F.count(F.lit(1)).alias("rows")).first()
    plain = c["ids"] == c["distinct"] and c["rows"] - c["ids"] <= 1
    return rows.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"),
                       (F.lit(0).cast("long") if plain else F.xxhash64("text")).alias("sub"), "text")


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def _frequent(rows: DataFrame, length: int, gram: int) -> np.ndarray:
    """Anchors with many different surroundings in a sample of documents; they only steer the shuffle."""
    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for text in b["text"]:
                h, seg, _, _ = surroundings(_raw(text), length, gram)
                yield pd.DataFrame({"anchor": h.view(np.int64), "seg": seg.view(np.int64)})

    sample = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "doc", "sub"), F.lit(SAMPLED)) == 0)
    counts = (sample.mapInPandas(seen, "anchor long, seg long").groupBy("anchor", "seg").agg(F.lit(1).alias("one"))
              .groupBy("anchor").count().where(F.col("count") >= 40).orderBy(F.desc("count"), "anchor").limit(FREQUENT))
    return np.sort(np.array([r.anchor for r in collect_bounded(counts, FREQUENT, "frequent anchors")], np.int64).view(np.uint64))


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _first_of_equal(x: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Rows sorted by (anchor, surroundings, place); the first of each equal group; strictly later ones."""
    o = np.lexsort((x["start"], x["sub"], x["doc"], x["seg"], x["anchor"]))
    x = {n: v[o] for n, v in x.items()}
    if not len(o):
        return x, np.zeros(0, bool), np.zeros(0, bool)
    head = np.concatenate(([True], (x["anchor"][1:] != x["anchor"][:-1]) | (x["seg"][1:] != x["seg"][:-1])))
    first = np.maximum.accumulate(np.where(head, np.arange(len(o)), 0))
    later = (x["doc"] != x["doc"][first]) | (x["sub"] != x["sub"][first]) | (x["start"] != x["start"][first])
    return x, head, later


def _by_anchor(rows: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """(kind, doc, sub, start, end, anchor): kind 0 is a mark, kind 1 surroundings to be indexed."""
    frequent = _frequent(rows, length, gram)

    def route(x: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        x, head, later = _first_of_equal(x)
        if later.any():
            m = {n: x[n][later] for n in ("doc", "sub", "start", "size")}
            yield pd.DataFrame({"bucket": [int(x["anchor"][0] % np.uint64(buckets))], "kind": [0], "blob": [pack(**m)]})
        x = {n: v[head] for n, v in x.items()}
        # a frequent anchor goes by its surroundings too
        where = ((x["anchor"] ^ np.where(_is_in(x["anchor"], frequent), x["seg"], np.uint64(0))) >> np.uint64(20)) % np.uint64(buckets)
        o = np.argsort(where, kind="stable")
        for part in np.split(o, np.flatnonzero(np.diff(where[o])) + 1):
            if len(part):
                yield pd.DataFrame({"bucket": [int(where[part[0]])], "kind": [1], "blob": [pack(**{n: v[part] for n, v in x.items()})]})

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for doc, sub, text in zip(b["doc"], b["sub"], b["text"], strict=True):
                h, seg, start, n = surroundings(_raw(text), length, gram)
                if len(h):
                    held.append({"anchor": h, "seg": seg, "doc": np.full(len(h), doc), "sub": np.full(len(h), sub), "start": start, "size": n})
                    size += len(h)
                if size >= HELD_ANCHORS:
                    yield from route(joined(held))
                    held, size = [], 0
        if held:
            yield from route(joined(held))

    def settle(blobs: list[bytes]) -> pd.DataFrame:
        x = joined([unpack(b, *(n for n, _ in _FIELDS)) for b in blobs])
        often = _is_in(x["anchor"], frequent)
        _, at, count = np.unique(x["anchor"], return_inverse=True, return_counts=True)
        x, head, later = _first_of_equal({n: v[(count[at] > 1) | often] for n, v in x.items()})
        # surroundings meet an index if their anchor has others, or may have them elsewhere
        _, at = np.unique(x["anchor"], return_inverse=True)
        different = np.bincount(at, weights=head) if len(at) else np.zeros(0)
        indexed = head & ((different[at] > 1) | _is_in(x["anchor"], frequent))
        take = np.concatenate((np.flatnonzero(later), np.flatnonzero(indexed)))
        kind = np.repeat([0, 1], [int(later.sum()), int(indexed.sum())])
        return pd.DataFrame({"kind": kind, "doc": x["doc"][take], "sub": x["sub"][take], "start": x["start"][take],
                             "end": x["start"][take] + x["size"][take], "anchor": x["anchor"][take].view(np.int64)})

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, blobs = None, []
        for b in batches:
            for k, kind, blob in zip(b["bucket"], b["kind"], b["blob"], strict=True):
                if kind == 0:
                    m = unpack(blob, "doc", "sub", "start", "size")
                    yield pd.DataFrame({"kind": 0, "doc": m["doc"], "sub": m["sub"], "start": m["start"],
                                        "end": m["start"] + m["size"], "anchor": np.int64(0)})
                    continue
                if k != bucket and blobs:
                    yield settle(blobs)
                    blobs = []
                bucket = k
                blobs.append(blob)
        if blobs:
            yield settle(blobs)

    small_batches(rows.sparkSession)
    return materialize(rows.mapInPandas(mapped, "bucket int, kind byte, blob binary").repartition("bucket").sortWithinPartitions("bucket")
                       .mapInPandas(reduced, "kind byte, doc long, sub long, start long, end long, anchor long"))


def _by_index(rows: DataFrame, places: DataFrame, length: int, buckets: int, salt_rows: int) -> DataFrame:
    """Marks and first starts from run-length indexes over the surroundings in places.

    (kind, doc, sub, start, end, a, b): kind 0 is a mark, kind 2 the first start of a string (hashes a, b)
    in one index of a salted anchor.
    """
    crowded = places.groupBy("anchor").count().where(F.col("count") > salt_rows)
    salts = F.ceil(F.coalesce(F.col("count"), F.lit(1)) / salt_rows).cast("int")
    placed = (places.join(crowded, "anchor", "left").withColumn("salts", salts)
              .groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "end", "anchor", "salts")).alias("places")))

    def handed(held: list[tuple]) -> Iterator[pd.DataFrame]:
        by: dict[int, list[tuple]] = {}
        for x in held:
            by.setdefault(x[0], []).append(x)
        for bucket, xs in by.items():
            yield pd.DataFrame({"bucket": [bucket], "blob": [pack(
                anchor=np.array([x[1] for x in xs], np.uint64), seg=np.array([x[2] for x in xs], np.uint64), doc=np.array([x[3] for x in xs]),
                sub=np.array([x[4] for x in xs]), start=np.array([x[5] for x in xs]), size=np.array([len(x[6]) for x in xs]))],
                "bytes": [b"".join(x[6] for x in xs)]})

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for doc, sub, text, where in zip(b["doc"], b["sub"], b["text"], b["places"], strict=True):
                raw = _raw(text)
                for p in where:
                    piece = raw[p["start"]:p["end"]]
                    salt = xxhash.xxh3_64_intdigest(piece) % p["salts"]
                    anchor = p["anchor"] & (1 << 64) - 1
                    held.append(((anchor ^ salt * 0x9E3779B97F4A7C15) % buckets, anchor ^ salt, int(p["salts"] > 1), doc, sub, p["start"], piece))
                    size += len(piece) + 120
                if size >= HELD_BYTES:
                    yield from handed(held)
                    held, size = [], 0
        yield from handed(held)

    def indexed(x: dict[str, np.ndarray], pieces: list[bytes]) -> Iterator[pd.DataFrame]:
        docs, at = np.unique(np.stack((x["doc"], x["sub"])), axis=1, return_inverse=True)
        position = (at.ravel().astype(np.int64) << 36) + x["start"]
        t, o, again = repeats(pieces, position, length)
        text, start, end = spans(t[again], o[again], length) if again.any() else (np.empty(0, np.int64),) * 3
        yield pd.DataFrame({"kind": 0, "doc": x["doc"][text], "sub": x["sub"][text], "start": x["start"][text] + start,
                            "end": x["start"][text] + end, "a": np.int64(0), "b": np.int64(0)})
        first = ~again & (x["seg"][t] > 0)
        for part in np.array_split(np.flatnonzero(first), max(1, int(first.sum()) // 20_000)):
            strings = [pieces[i][j:j + length] for i, j in zip(t[part].tolist(), o[part].tolist(), strict=True)]
            a = np.array([xxhash.xxh3_64_intdigest(s) for s in strings], np.uint64).view(np.int64)
            b = np.array([xxhash.xxh64_intdigest(s) for s in strings], np.uint64).view(np.int64)
            begin = x["start"][t[part]] + o[part]
            yield pd.DataFrame({"kind": 2, "doc": x["doc"][t[part]], "sub": x["sub"][t[part]], "start": begin, "end": begin + length, "a": a, "b": b})

    def settle(blobs: list[tuple[bytes, bytes]]) -> Iterator[pd.DataFrame]:
        x = joined([unpack(m, *(n for n, _ in _FIELDS)) for m, _ in blobs])
        raw = b"".join(r for _, r in blobs)
        end = np.cumsum(x["size"].astype(np.int64))
        o = np.argsort(x["anchor"], kind="stable")
        new = np.concatenate(([True], np.diff(x["anchor"][o]) != 0))
        volume = np.cumsum(x["size"][o].astype(np.int64))
        # an index takes whole anchors, and several of them up to INDEX_BYTES
        cuts, base = [0], 0
        for i in np.flatnonzero(new).tolist():
            if i and volume[i - 1] - base >= INDEX_BYTES:
                cuts.append(i)
                base = volume[i - 1]
        for i, j in zip(cuts, [*cuts[1:], len(o)], strict=True):
            part = o[i:j]
            yield from indexed({n: v[part] for n, v in x.items()},
                               [raw[e - s:e] for e, s in zip(end[part].tolist(), x["size"][part].tolist(), strict=True)])

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, blobs = None, []
        for b in batches:
            for k, blob, raw in zip(b["bucket"], b["blob"], b["bytes"], strict=True):
                if k != bucket and blobs:
                    yield from settle(blobs)
                    blobs = []
                bucket = k
                blobs.append((blob, raw))
        if blobs:
            yield from settle(blobs)

    small_batches(rows.sparkSession, 64)
    return materialize(rows.join(placed, ["doc", "sub"]).select("doc", "sub", "text", "places")
                       .mapInPandas(mapped, "bucket int, blob binary, bytes binary").repartition("bucket").sortWithinPartitions("bucket")
                       .mapInPandas(reduced, "kind byte, doc long, sub long, start long, end long, a long, b long"))


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, salt_rows: int = SALT_ROWS) -> tuple[DataFrame, DataFrame]:
    """The keyed rows of docs, and marks (doc, sub, start, end) whose union is all bytes to remove."""
    if not 8 <= gram <= length:
        raise ValueError("a gram must have at least 8 bytes and fit into the length")
    spark = docs.sparkSession
    rows = _keyed(docs)
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = _by_anchor(rows, length, gram, buckets)
    forget()
    more = _by_index(rows, found.where("kind = 1").select("doc", "sub", "start", "end", "anchor"), length, buckets, salt_rows)
    forget()
    marks = found.where("kind = 0").select("doc", "sub", "start", "end").unionByName(
        more.where("kind = 0").select("doc", "sub", "start", "end"))
    firsts = more.where("kind = 2").select("a", "b", "doc", "sub", "start", "end")
    least = firsts.groupBy("a", "b").agg(F.min(F.struct("doc", "sub", "start")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    across = firsts.join(least, ["a", "b"]).where(F.struct("doc", "sub", "start") > F.col("least"))
    return rows, marks.unionByName(across.select("doc", "sub", "start", "end"))


def cut(raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int]:
    """The bytes outside the marks, and how many maximal runs the marks form."""
    o = np.argsort(start, kind="stable")
    start, reach = start[o], np.maximum.accumulate(end[o])
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    first = start[new]
    last = reach[np.append(np.flatnonzero(new)[1:], len(start)) - 1]
    kept = b"".join(raw[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(raw)], strict=True))
    return kept, len(first)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans of every row of docs.

    A null text is empty. Rows with a null doc_id come last in the corpus order. Rows repeated with the
    same doc_id and text are one place, so none starts before the other; different texts of one doc_id are
    ordered by their hash. Texts shorter than `length` bytes stay whole.
    """
    rows, marks = repeated(docs, length, gram, salt_rows)
    by_doc = marks.groupBy("doc", "sub").agg(F.collect_list("start").alias("start"), F.collect_list("end").alias("end"))

    def applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kept, total, count = [], [], []
            for text, start, end in zip(b["text"], b["start"], b["end"], strict=True):
                raw = _raw(text)
                k, n = (raw, 0) if start is None else cut(raw, np.asarray(start), np.asarray(end))
                kept.append(k)
                total.append(len(raw))
                count.append(n)
            yield pd.DataFrame({"doc": b["doc"], "kept": kept, "n_bytes": total, "n_spans": count})

    small_batches(docs.sparkSession)
    done = (rows.join(by_doc, ["doc", "sub"], "left").select("doc", "text", "start", "end")
            .mapInPandas(applied, "doc long, kept binary, n_bytes long, n_spans long"))
    return done.select(F.when(F.col("doc") != (1 << 63) - 1, F.col("doc")).alias("doc_id"), "kept", "n_bytes",
                       (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), "n_spans")


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows of docs, all columns, with the repeats cut out of text and n_chars set to what is left.

    Of a character that is cut through the rest is dropped. Rows of which nothing is left go; rows whose
    text was empty or null before stay as they are.
    """
    rows, marks = repeated(docs, length, gram)
    by_doc = marks.groupBy("doc", "sub").agg(F.collect_list("start").alias("_start"), F.collect_list("end").alias("_end"))
    tied = rows.limit(1).select("sub").first()
    sub = F.lit(0).cast("long") if tied is None or tied["sub"] == 0 else F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    wide = docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), "_sub": sub})
    wide = wide.join(by_doc.withColumnsRenamed({"doc": "_doc", "sub": "_sub"}), ["_doc", "_sub"], "left").drop("_doc", "_sub")

    def applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            gone = []
            for i, (text, start, end) in enumerate(zip(b["text"], b["_start"], b["_end"], strict=True)):
                if start is not None:
                    kept = cut(_raw(text), np.asarray(start), np.asarray(end))[0].decode("utf-8", "ignore")
                    b.iat[i, b.columns.get_loc("text")] = kept
                    if not kept:
                        gone.append(b.index[i])
            yield b.drop(index=gone).drop(columns=["_start", "_end"])

    small_batches(docs.sparkSession)
    out = wide.mapInPandas(applied, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
