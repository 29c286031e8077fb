"""Removal of lines that many documents hold, by a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z in lower case; its hash has 128 bits. One
aggregation counts, over all documents, in how many each hash occurs. The distinct hashes of at least
`min_docs` documents are dealt by hash to shards of about SHARD_KEYS keys, each built in a task of its own:
a minimal perfect hash (levels of bit arrays; a key rests at the first level where it is alone in its place,
and the rank of its bit is its slot) and, by slot, an array of 64-bit fingerprints and one of document
counts. A key that was not indexed falls on some slot and is refused by the fingerprint.

Documents probe the arrays. While the shards' measured bytes stay below INDEX_BYTES they are broadcast and
one scan of the texts finishes the work. Beyond that the documents' line hashes go to the shards: a shard is
copied to as many cells as the counts of its own lines call for, so a line that a third of all documents
hold is spread, and what the probes find goes back to the documents. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import small_batches, whole_batches
from snapmill.runtime import materialize

WHITE = b" \t\n\v\f\r"
SHARD_KEYS = 65_536
INDEX_BYTES = 32 << 20
CELL_PROBES = 1_000_000
GAMMA = 2.0
FLUSH = 200_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of both halves, another for each level."""
    with np.errstate(over="ignore"):
        x = (high + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) ^ (low * _M1)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27)) ^ low) * _M2
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys, with fingerprint and count arrays by slot."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> None:
        self.sizes, self.words, self.prints, self.counts = sizes, words, prints, counts
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> PerfectHash:
        left = np.arange(len(high))
        sizes, bits = [], []
        while len(left):
            size = -(-max(int(len(left) * GAMMA), 64) // 64) * 64
            place = (_mix(high[left], low[left], len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[place]]
        out = cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint64), *bits]), np.zeros(len(high), np.uint64),
                  np.zeros(len(high), np.int64))
        slot = out.slots(high, low)
        out.prints[slot], out.counts[slot] = high, counts
        return out

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of every key, from 0; -1 where no level holds a bit (then the key is not a member)."""
        slot = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self.starts[level] + (_mix(high[left], low[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[here]] = (self.ranks[at >> 6] + below)[here]
            left = left[~here]
        return slot

    def probe(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The count of every key, 0 for a key that was not indexed."""
        found = np.zeros(len(high), np.int64)
        slot = self.slots(high, low)
        at = np.nonzero(slot >= 0)[0]
        at = at[self.prints[slot[at]] == high[at]]
        found[at] = self.counts[slot[at]]
        return found

    def pack(self) -> tuple[bytes, bytes, bytes, bytes]:
        return self.sizes.tobytes(), self.words.tobytes(), self.prints.tobytes(), self.counts.astype("<u4" if self.counts.max(initial=0) < 1 << 32 else "<u8").tobytes()

    @classmethod
    def unpack(cls, sizes: bytes, words: bytes, prints: bytes, counts: bytes) -> PerfectHash:
        p = np.frombuffer(prints, np.uint64)
        kind = "<u4" if len(counts) == 4 * len(p) else "<u8"
        return cls(np.frombuffer(sizes, np.int64), np.frombuffer(words, np.uint64), p, np.frombuffer(counts, kind).astype(np.int64))


def lines_of(text: str) -> list[bytes]:
    """The keys of a text's lines, in order; only A-Z have another byte in lower case."""
    return [line.strip(WHITE) for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def _hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """High and low halves of the keys' 128-bit hashes."""
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _shard(high: np.ndarray, shards: int) -> np.ndarray:
    return (high % np.uint64(shards)).astype(np.int64)


def count_lines(docs: DataFrame) -> DataFrame:
    """high, low, n_docs: every distinct key of at least one character, with the documents that hold it."""
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, int] = {}

        def flush() -> pd.DataFrame:
            h = np.frombuffer(b"".join(held), ">u8").astype(np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"high": h[:, 0], "low": h[:, 1], "n": np.fromiter(held.values(), np.int64, len(held))})

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for text in batch["text"]:
                for k in set(lines_of(text)):
                    if k:
                        d = digest(k)
                        held[d] = held.get(d, 0) + 1
                if len(held) >= FLUSH:
                    yield flush()
                    held = {}
        if held:
            yield flush()

    return docs.mapInPandas(keys, "high long, low long, n long").groupBy("high", "low").agg(F.sum("n").alias("n_docs"))


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its perfect hash and arrays, and how many documents its keys occur in altogether."""
    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = PerfectHash.build(part["high"].to_numpy(np.int64).view(np.uint64), part["low"].to_numpy(np.int64).view(np.uint64),
                                 part["n_docs"].to_numpy(np.int64))
        sizes, words, prints, n = made.pack()
        return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "sizes": [sizes], "words": [words], "prints": [prints],
                             "counts": [n], "probes": [int(part["n_docs"].sum())]})

    # the remainder of the high half as an unsigned number
    unsigned = F.pmod(F.pmod(F.col("high"), F.lit(shards)) + F.when(F.col("high") < 0, F.lit((1 << 64) % shards)).otherwise(0), F.lit(shards))
    return counts.withColumn("shard", unsigned.cast("int")).groupBy("shard").applyInPandas(
        build, "shard int, sizes binary, words binary, prints binary, counts binary, probes long")


def _result(doc_id: str | None, text: str, keys: list[bytes], drop: np.ndarray, most: int) -> tuple:
    if drop.any():
        kept = "\n".join([line for line, d in zip(text.split("\n"), drop.tolist(), strict=True) if not d])
    else:
        kept = text
    return doc_id, len(keys), int(drop.sum()), kept, most


# ids travel as text: pandas would make a column with nulls a floating one
RESULT = "doc_id string, n_lines long, n_dropped long, kept string, most_docs long"


def _table(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "n_lines", "n_dropped", "kept", "most_docs"])


def drop_common_lines(docs: DataFrame, min_docs: int = 10, shard_keys: int = SHARD_KEYS, index_bytes: int = INDEX_BYTES,
                      cell_probes: int = CELL_PROBES) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept, most_docs: texts without the lines that at least min_docs documents hold.

    A text is split at \\n; a null or empty text is one empty line. Lines whose key is empty always stay. Each
    row is a document, also where a doc_id is null or repeated, and a line counts once per document. kept joins
    the other lines by \\n; if none is left it is empty. most_docs is the largest number of documents that hold
    one of the dropped lines, 0 without any. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    common = materialize(count_lines(texts.select("text")).where(F.col("n_docs") >= min_docs))
    n = common.count()
    shards = max(1, -(-n // shard_keys))
    whole_batches(spark)
    index = materialize(build_index(common, shards))
    size = sum(F.octet_length(c) for c in ("sizes", "words", "prints", "counts"))
    total = index.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    small_batches(spark)
    found = _by_broadcast(texts, index, shards) if total <= index_bytes else _by_cells(texts, index, shards, cell_probes)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _by_broadcast(texts: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Probe arrays that every executor holds; their bytes were measured before."""
    held = {r["shard"]: (r["sizes"], r["words"], r["prints"], r["counts"]) for r in index.collect()}
    sent = texts.sparkSession.sparkContext.broadcast(held)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = {s: PerfectHash.unpack(*parts) for s, parts in sent.value.items()}
        for batch in batches:
            ids, texts_ = batch["doc_id"].tolist(), batch["text"].tolist()
            keys = [lines_of(t) for t in texts_]
            # one set of hashes for a whole batch
            distinct = list({k for ks in keys for k in ks if k})
            found = np.zeros(len(distinct), np.int64)
            if distinct:
                high, low = _hashes(distinct)
                shard = _shard(high, shards)
                for s in np.unique(shard).tolist():
                    if s in tables:
                        at = np.nonzero(shard == s)[0]
                        found[at] = tables[s].probe(high[at], low[at])
            common = {k: c for k, c in zip(distinct, found.tolist(), strict=True) if c}
            rows = []
            for doc_id, text, ks in zip(ids, texts_, keys, strict=True):
                n = [common.get(k, 0) for k in ks]
                rows.append(_result(doc_id, text, ks, np.array(n) > 0, max(n)))
            yield _table(rows)

    return texts.mapInPandas(probe, RESULT)


def _by_cells(texts: DataFrame, index: DataFrame, shards: int, cell_probes: int) -> DataFrame:
    """Send line hashes to copies of the shards, and what they find back to the documents."""
    spark = texts.sparkSession
    # rows get a number of their own, since doc_id may be null or repeated; the written table fixes it
    rows = materialize(texts.withColumn("row", F.monotonically_increasing_id()))

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, text in zip(batch["row"].tolist(), batch["text"].tolist(), strict=True):
                keys = [k for k in set(lines_of(text)) if k]
                if keys:
                    high, low = _hashes(keys)
                    yield pd.DataFrame({"row": row, "shard": _shard(high, shards).astype(np.int32), "high": high.view(np.int64), "low": low.view(np.int64)})

    probes = materialize(rows.select("row", "text").mapInPandas(hashes, "row long, shard int, high long, low long"))
    spare = probes.count() // shards
    # cells of a shard: enough for the documents of its own lines and its share of all others
    copies = index.select("shard", F.ceil((F.col("probes") + spare + 1) / cell_probes).cast("int").alias("cells"))
    cells = materialize(index.join(copies, "shard").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).drop("cells", "probes"))
    spread = (probes.join(F.broadcast(copies), "shard")
              .withColumn("cell", F.pmod(F.xxhash64("row"), F.col("cells")).cast("int")).drop("cells"))

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"row": [], "high": [], "low": [], "n_docs": []})
        r = held.iloc[0]
        table = PerfectHash.unpack(r["sizes"], r["words"], r["prints"], r["counts"])
        c = table.probe(asked["high"].to_numpy(np.int64).view(np.uint64), asked["low"].to_numpy(np.int64).view(np.uint64))
        return asked[["row", "high", "low"]].assign(n_docs=c)[c > 0]

    whole_batches(spark)
    hits = materialize(spread.groupBy("shard", "cell").cogroup(cells.groupBy("shard", "cell"))
                       .applyInPandas(meet, "row long, high long, low long, n_docs long"))
    # a document has at most as many hits as it has distinct lines
    per_row = hits.groupBy("row").agg(F.collect_list(F.struct("high", "low", "n_docs")).alias("hits"))
    small_batches(spark)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, hit in zip(batch["doc_id"].tolist(), batch["text"].tolist(), batch["hits"].tolist(), strict=True):
                keys = lines_of(text)
                common = {(h["high"], h["low"]): h["n_docs"] for h in hit} if hit is not None else {}
                high, low = _hashes(keys)
                marks = zip(high.view(np.int64).tolist(), low.view(np.int64).tolist(), strict=True)
                c = [common.get(m, 0) if k else 0 for k, m in zip(keys, marks, strict=True)]
                out.append(_result(doc_id, text, keys, np.array(c) > 0, max(c)))
            yield _table(out)

    return rows.join(per_row, "row", "left").select("doc_id", "text", "hits").mapInPandas(cut, RESULT)
