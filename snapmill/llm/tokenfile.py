"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Texts are encoded with a given tokenizer and ended by an end id. An id is stored as its rank by
frequency over the whole corpus, so frequent ids take one byte; four ranks share one control byte with
their byte counts. A block holds whole documents: header, document ids, their token counts, control
bytes, data bytes. Blocks are rows of a Parquet table (so tasks commit them atomically on any store),
in ascending doc_id order over parts and positions. Decoding looks control bytes up in tables.

Encoding makes two passes: tokenize once into a table, count ids (at most the vocabulary's size reaches
the driver), then one range shuffle by doc_id writes the blocks. Starts need only one number per part.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmill.llm.common import forget, small_batches, texts
from snapmill.runtime import collect_bounded, scratch_path

END_ID = 2
BLOCK_IDS = 1 << 20
MAX_VOCABULARY = 4_000_000
HEADER = "<4sIQQ"
MAGIC = b"VBR1"
CACHED_WORDS = 500_000

# the pattern that byte-level tokenizers split by (fixed value), used on texts of plain Latin characters
# only, where every implementation of its classes agrees
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER = re.compile("[^\t\n\r\x20-\x7e\xa0-\u024f]")
# spaces that do not stand alone between two words, and ends of lines beside other white space
UNEVEN = ("  ", *(x for c in "\t\n\r\xa0" for x in (f" {c}", f"{c} ")))
UNEVEN_LINES = tuple(x for c in "\t\n\r\xa0" for x in (f"\n{c}", f"{c}\n"))


def byte_characters() -> list[str]:
    """The character that byte-level tokenizers write for each byte: itself if it is printable."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Remembered(dict):
    """Values made once by key; when full, the older half is forgotten."""

    def __init__(self, make, limit: int = CACHED_WORDS) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.limit:
            for old in list(islice(self, self.limit // 2)):
                del self[old]
        self[key] = value
        return value


class Encoder:
    """Ids of whole texts as bytes of little-endian unsigned integers of `kind`.

    A byte-level tokenizer that splits by SPLIT encodes every piece by itself, so words and pieces are
    encoded once and remembered; a text with other characters or with a special token is encoded as a
    whole.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.to_str())
        split = state.get("pre_tokenizer") or {}
        self.by_piece = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                         and not state.get("normalizer") and state["model"].get("type") == "BPE")
        self.special = [t["content"] for t in state.get("added_tokens", [])]
        # ids may have gaps, so the largest counts
        top = max(self.tokenizer.get_vocab().values(), default=0)
        self.kind = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        written = [i.to_bytes(self.kind.itemsize, "little") for i in range(top + 1)]
        table, tokenize, split_up, join = byte_characters(), self.tokenizer.model.tokenize, regex.compile(SPLIT).findall, b"".join
        space = table[32]

        def piece(text: str) -> bytes:
            shown = text.replace(" ", space) if text.isascii() and text.isprintable() else "".join([table[b] for b in text.encode("utf-8")])
            return join([written[t.id] for t in tokenize(shown)])

        def word(text: str) -> bytes:
            """A word after a space; letters and one closing mark need no pattern."""
            if text.isalpha():
                return join([written[t.id] for t in tokenize(space + text)]) if text.isascii() else piece(f" {text}")
            if text[-1:] in (".", ",") and text[:-1].isalpha():
                return self.words[text[:-1]] + marks[text[-1]]
            return self.split(f" {text}")

        def opening(text: str) -> bytes:
            """A word that no space precedes."""
            if text.isalpha():
                return marks[text]
            if text[-1:] in (".", ",") and text[:-1].isalpha():
                return marks[text[:-1]] + marks[text[-1]]
            return self.split(text)

        marks = Remembered(piece, CACHED_WORDS // 4)
        self.split = lambda text: join(map(marks.__getitem__, split_up(text)))
        self.opening, self.line_end = opening, marks["\n"] if self.by_piece else b""
        self.words = Remembered(word)

    def encode(self, batch: list[str]) -> list[bytes]:
        out: list[bytes] = []
        known = self.words.__getitem__
        for text in batch:
            if not self.by_piece or OTHER.search(text) or any(s in text for s in self.special):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.array(ids, self.kind).tobytes())
            elif text[:1] == " " or text[-1:] == " " or any(u in text for u in UNEVEN):
                out.append(self.split(text))
            else:
                # an end of line that stands alone is a piece, so no word is remembered together with the next line's first
                alone = text[:1] != "\n" and text[-1:] != "\n" and not any(u in text for u in UNEVEN_LINES)
                lines = []
                for line in text.split("\n") if alone else (text,):
                    first, *rest = line.split(" ")
                    lines.append(self.opening(first) + b"".join(map(known, rest)))
                out.append(self.line_end.join(lines))
        return out


@cache
def encoder_of(path: str) -> Encoder:
    """This process's encoder of a tokenizer file: a worker serves many tasks and keeps what it remembers."""
    return Encoder(path)


# byte counts and offsets of the four values of each control byte
_CODES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
_SIZES = _CODES + 1
_OFFSETS = np.concatenate((np.zeros((256, 1), np.int64), np.cumsum(_SIZES, axis=1)[:, :3]), axis=1)
_TOTALS = _SIZES.sum(axis=1)
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values; the last control byte is filled with zeros."""
    v = np.zeros(-(-len(values) // 4) * 4, "<u4")
    v[:len(values)] = values
    code = (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    quads = code.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    width = int(code.max(initial=0)) + 1  # bytes of the largest value; wider ones need no look
    data = v.view(np.uint8).reshape(-1, 4)[:, :width][np.arange(width) <= code[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values again, by table lookup over the control bytes."""
    c = np.frombuffer(control, np.uint8)
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)))
    start = np.concatenate(([0], np.cumsum(_TOTALS[c])[:-1])) if len(c) else np.zeros(0, np.int64)
    at = (start[:, None] + _OFFSETS[c]).ravel()[:count]
    codes = _CODES[c].ravel()[:count]
    words = raw[at].astype(np.uint32)
    for b in range(1, int(codes.max(initial=0)) + 1):
        words |= raw[at + b].astype(np.uint32) << np.uint32(8 * b)
    return words & _MASKS[codes]


def pack_block(doc_ids: list, ids: list[np.ndarray], rank: np.ndarray) -> bytes:
    """One block of whole documents; a null doc_id is written as the smallest long."""
    joined = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    control, data = pack_values(rank[joined])
    keys = np.array([np.iinfo(np.int64).min if k is None or k != k else int(k) for k in doc_ids], "<i8")
    counts = np.array([len(x) for x in ids], "<u4")
    return b"".join((struct.pack(HEADER, MAGIC, len(ids), len(joined), len(control)), keys.tobytes(), counts.tobytes(), control, data))


def unpack_block(block: bytes, by_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, token counts and all ids of one block."""
    magic, docs, total, width = struct.unpack_from(HEADER, block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = struct.calcsize(HEADER)
    keys = np.frombuffer(block, "<i8", docs, at)
    counts = np.frombuffer(block, "<u4", docs, at + 8 * docs)
    at += 12 * docs
    return keys, counts, by_rank[unpack_values(block[at:at + width], block[at + width:], total)]


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write path/blocks and path/ranks (rank, id)."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8"):
        pass  # a missing file fails here, not in every task

    def tokenized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(tokenizer_path)
        end = np.array([end_id], encoder.kind).tobytes()
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "width": np.int8(encoder.kind.itemsize),
                                "ids": [x + end for x in encoder.encode(b["text"].tolist())]})

    raw = scratch_path(spark, "ids")
    texts(docs).mapInPandas(tokenized, "doc_id long, width byte, ids binary").write.option("compression", "zstd").parquet(raw)
    ids = spark.read.parquet(raw)

    def values(b: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(x, f"<u{w}").astype(np.uint32) for x, w in zip(b["ids"], b["width"], strict=True)]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder_of.cache_clear()  # all texts are encoded; workers live on, and need their memory for the ids
        total = np.zeros(1, np.int64)
        for b in batches:
            if len(b):
                n = np.bincount(np.concatenate(values(b)), minlength=len(total))
                n[:len(total)] += total
                total = n
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used.astype(np.int64), "n": total[used]})

    counts = (ids.mapInPandas(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")))
    order = sorted(collect_bounded(counts, MAX_VOCABULARY, "token ids"), key=lambda r: (-r.n, r.id))
    rank = np.zeros(max((r.id for r in order), default=0) + 1, np.uint32)
    for i, r in enumerate(order):
        rank[r.id] = i
    spark.createDataFrame(pd.DataFrame({"rank": np.arange(len(order)), "id": [r.id for r in order]}).astype("int64"),
                          "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder_of.cache_clear()
        part, before, keys, held, size = TaskContext.get().partitionId(), 0, [], [], 0
        for b in batches:
            for key, x in zip(b["doc_id"].astype("object"), values(b), strict=True):
                if held and size + len(x) > block_ids:
                    yield pd.DataFrame({"part": [part], "before": [before], "n_ids": [size], "block": [pack_block(keys, held, rank)]})
                    before, keys, held, size = before + size, [], [], 0
                keys.append(None if pd.isna(key) else key)
                held.append(x)
                size += len(x)
        if held:
            yield pd.DataFrame({"part": [part], "before": [before], "n_ids": [size], "block": [pack_block(keys, held, rank)]})

    (ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
     .mapInPandas(blocks, "part int, before long, n_ids long, block binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    forget()


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (as little-endian unsigned 32-bit integers) of every document."""
    by_rank = np.array([r.id for r in sorted(collect_bounded(spark.read.parquet(f"{path}/ranks"), MAX_VOCABULARY, "token ids"),
                                             key=lambda r: r.rank)], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    small_batches(spark, 4)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, block in zip(b["offset"] + b["before"], b["block"], strict=True):
                keys, counts, ids = unpack_block(block, by_rank)
                ends = np.cumsum(counts, dtype=np.int64)
                keys = pd.array(keys, "Int64")
                keys[keys == np.iinfo(np.int64).min] = pd.NA
                for at in range(0, len(keys), 256):
                    s = slice(at, at + 256)
                    yield pd.DataFrame({"doc_id": keys[s], "start": first + ends[s] - counts[s], "n_tokens": counts[s].astype(np.int64),
                                        "ids": [ids[e - n:e].tobytes() for e, n in zip(ends[s], counts[s].astype(np.int64), strict=True)]})

    return (blocks.join(F.broadcast(parts), "part").select("offset", "before", "block")
            .mapInPandas(documents, "doc_id long, start long, n_tokens long, ids binary"))


def token_file(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, n_tokens, ids of every row of docs, written to a file and read back.

    Null and empty texts are just the end id. Documents are ordered by doc_id, null ones first, and rows
    repeated with the same doc_id by their ids.
    """
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, tokenizer_path, path, end_id)
    return read_back(docs.sparkSession, path)
