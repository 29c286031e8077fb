"""Benchmark decontamination by template canonicalisation.

Texts become sequences of template tokens: numbers, names and units are replaced by typed placeholders
and other words are lower-cased without their punctuation. Windows of WINDOW template tokens are
hash-joined with those of the benchmark, and so are windows of the plain lower-cased words, since names are
told by their capitals and a re-cased copy has others. A template window that matches carries slot values
and its place; inside
one occurrence of an item the same benchmark value must always be replaced by the same document value
(and differing ones may not be mixed up), else the windows that contradict the majority do not count.
Each place of a document where an item may begin is judged by itself, so variants side by side do not
contradict one another. So re-parameterised questions are caught, texts that merely share a pattern are not.

A document is contaminated if the template windows or the plain windows of some item are matched to at
least SIMILARITY. The benchmark's windows are joined as a broadcast only up to a checked number of rows; the
documents contribute rows for matching windows only. Words are numbered once per worker, so that a text's
tokens and windows are array lookups, and slot values are gathered for matching windows alone.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import small_batches, texts, whole_batches, without
from snapmill.runtime import materialize

WINDOW = 5
SIMILARITY = 0.8
# benchmark windows that may be held by every task (16 bytes each); beyond it the windows are shuffled
MEMORY_WINDOWS = 1_000_000

# fixed values: units of measure, as whole words
UNITS = frozenset(
    "mm cm m km inch inches in. ft foot feet yard yards mile miles mg g kg lb lbs oz ounce ounces pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years dollar dollars usd eur euro euros cent cents percent % km/h mph degree degrees "
    "meter meters metre metres gram grams".split())
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?$")
NUMBER_UNIT = re.compile(r"([+-]?\d[\d.,]*)([a-zA-Z%/]+)$")
NUMBER_WORDS = frozenset("one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
EDGE = ".,;:!?\"'()[]{}*_«»“”‘’…"
NUM, NAME, UNIT = "\x01num", "\x01name", "\x01unit"


def word(raw: str, initial: bool) -> list[tuple[str, str]]:
    """Template tokens of one word, each with its slot value ('' for a plain word)."""
    bare = raw.strip(EDGE)
    low = bare.lower()
    if not low:
        return []
    if NUMBER.match(bare) or low in NUMBER_WORDS:
        return [(NUM, low)]
    if low in UNITS:
        return [(UNIT, low)]
    both = NUMBER_UNIT.match(bare)
    if both and both[2].lower() in UNITS:
        return [(NUM, both[1]), (UNIT, both[2].lower())]
    if not initial and bare[0].isupper() and not bare.isupper():
        return [(NAME, low)]
    return [(low, "")]


SPECIAL = UNITS | NUMBER_WORDS
DIGIT = re.compile(r"\d")
_NAME_HASH, _UNIT_HASH = xxhash.xxh3_64_intdigest(NAME), np.uint64(xxhash.xxh3_64_intdigest(UNIT))
TEMPLATE, PLAIN = 0, 1
# set apart the windows of plain words from those of templates
_PLAIN_SALT = np.uint64(0xA24BAED4963EE407)


class Tokens:
    """Template and plain tokens of one text; `at_lines` are the numbers of the words that begin a line.

    A word inside a sentence is a name if it has a capital. Where a line begins without a sentence's end before
    it, the word may stand inside or begin one (as a title before it has no mark), so there are two templates.
    """

    def __init__(self, words: Canonical, ids: np.ndarray, at_lines: list[int]) -> None:
        initial = np.ones(len(ids), bool)
        initial[1:] = _view(words.ends, bool)[ids[:-1]]
        by_line = initial.copy()
        by_line[at_lines] = True
        n = _view(words.count, np.int8)[ids]
        if not n.all():
            ids, initial, by_line, n = ids[n > 0], initial[n > 0], by_line[n > 0], n[n > 0]
        self.words, self.ids = words, ids
        self.plain = _view(words.first)[ids]
        start, inside = _view(words.start)[ids], _view(words.inside)[ids]
        self.word_of, self.second = None, None
        if len(n) and n.max() > 1:
            # a number with its unit gives two tokens
            self.word_of = np.repeat(np.arange(len(ids)), n)
            self.second = np.zeros(len(self.word_of), bool)
            self.second[np.cumsum(n)[n > 1] - 1] = True
        self.initials = [initial]
        self.templates = [self._tokens(initial, start, inside)]
        if (by_line & ~initial & (start != inside)).any():
            self.initials.append(by_line)
            self.templates.append(self._tokens(by_line, start, inside))

    def _tokens(self, initial: np.ndarray, start: np.ndarray, inside: np.ndarray) -> np.ndarray:
        found = np.where(initial, start, inside)
        return found if self.word_of is None else np.where(self.second, _UNIT_HASH, found[self.word_of])

    def windows(self, size: int) -> list[tuple[np.ndarray, np.ndarray | None, int]]:
        """(hashes, places, which template) of the template windows; of the second template those that differ."""
        out = [(windows(self.templates[0], size), None, 0)]
        if len(self.templates) > 1:
            other = windows(self.templates[1], size)
            place = np.flatnonzero(other != out[0][0])
            out.append((other[place], place, 1))
        return out

    def slots(self, at: int, size: int, which: int = 0) -> list[str]:
        """Slot values of the template tokens from `at` on."""
        out = []
        for i in range(at, min(at + size, len(self.templates[0]))):
            w = i if self.word_of is None else int(self.word_of[i])
            values = word(self.words.raw[self.ids[w]], bool(self.initials[which][w]))
            out.append(values[1 if self.second is not None and self.second[i] else 0][1])
        return out


def _view(values: array | bytearray, kind: type = np.uint64) -> np.ndarray:
    """The values as an array, to be let go before more are appended."""
    return np.frombuffer(values, kind)


class Canonical(dict):
    """Words by number: hashes of their plain form and of their template token at a sentence's start and
    inside, how many template tokens they are, and whether a sentence ends with them."""

    def __init__(self, limit: int = 300_000) -> None:
        super().__init__()
        self.limit = limit
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.raw: list[str] = []
        self.first, self.start, self.inside = array("Q"), array("Q"), array("Q")
        self.count, self.ends = bytearray(), bytearray()

    def __missing__(self, raw: str) -> int:
        n = len(self.raw)
        bare = raw.strip(EDGE)
        low = bare.lower()
        plain = xxhash.xxh3_64_intdigest(low)
        start = inside = plain
        count = 1
        if not low:
            count = 0
        elif low in SPECIAL or DIGIT.search(low):
            found, other = word(raw, True), word(raw, False)
            start, inside = (xxhash.xxh3_64_intdigest(f[0][0]) for f in (found, other))
            count = len(found)
        elif bare[0].isupper() and not bare.isupper():
            inside = _NAME_HASH
        self.raw.append(raw)
        self.first.append(plain)
        self.start.append(start)
        self.inside.append(inside)
        self.count.append(count)
        self.ends.append(raw[-1] in ".!?:")
        self[raw] = n
        return n

    def tokens(self, text: str) -> Tokens:
        if len(self) > self.limit:
            self._empty()
        words: list[str] = []
        at_lines: list[int] = []
        for line in text.split("\n"):
            at_lines.append(len(words))
            words += line.split()
        return Tokens(self, np.fromiter(map(self.__getitem__, words), np.int64, len(words)), [i for i in at_lines if i < len(words)])


def windows(hashes: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Hash of each window of `size` tokens; a shorter text is one window."""
    size = min(size, len(hashes))
    if not size:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - size + 1 + i]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def plain_windows(hashes: np.ndarray, size: int = WINDOW) -> np.ndarray:
    return windows(hashes, size) ^ _PLAIN_SALT


class Wanted:
    """Membership of window hashes: a bit map by their upper bits first, then the ordered hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.ordered = np.sort(hashes)
        self.map = np.zeros(1 << 20, bool)
        self.map[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, w: np.ndarray) -> np.ndarray:
        some = np.flatnonzero(self.map[(w >> np.uint64(44)).astype(np.int64)])
        if not len(some) or not len(self.ordered):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.ordered, w[some]), len(self.ordered) - 1)
        return some[self.ordered[at] == w[some]]


def _windows_of(rows: DataFrame, key: str, wanted: np.ndarray | None, size: int, short: tuple[int, ...] = ()) -> DataFrame:
    """(key, kind, window, at, slots) of each text's windows, of those in `wanted` if it is given.

    at is the place in the text; the upper bits of a document's places tell different texts of one id apart.
    Plain windows have no slots; those of the lengths in `short` are given besides.
    """
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonical = Canonical()
        member = None if wanted is None else Wanted(wanted)
        for b in batches:
            ids, kinds, ws, at, slots = [], [], [], [], []
            for k, text in zip(b["doc_id"], b["text"], strict=True):
                t = canonical.tokens(text)
                plain = t.plain
                base = None
                # a benchmark item has one template
                made = t.windows(size)[:1] if key == "item_id" else t.windows(size)
                for kind, w, place, which in [*((TEMPLATE, *m) for m in made), (PLAIN, plain_windows(plain, size), None, 0),
                                              *((PLAIN, plain_windows(plain, n), None, 0) for n in short if n < min(size, len(plain)))]:
                    hit = np.arange(len(w)) if member is None else member.hits(w)
                    if not len(hit):
                        continue
                    if base is None:
                        base = 0 if key == "item_id" else (xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 33) << 32
                    here = (hit if place is None else place[hit]).tolist()
                    ids += [k] * len(here)
                    kinds += [kind] * len(here)
                    at += [base + i for i in here]
                    slots += [t.slots(i, size, which) for i in here] if kind == TEMPLATE else [[]] * len(here)
                    ws.append(w[hit])
            yield pd.DataFrame({key: ids, "kind": kinds, "window": np.concatenate(ws).view(np.int64) if ws else np.empty(0, np.int64),
                                "at": at, "slots": pd.Series(slots, dtype=object)}).astype({key: "Int64", "kind": "int8", "at": "int64"})

    return rows.mapInPandas(found, f"{key} long, kind byte, window long, at long, slots array<string>")


def _choose(pairs: list[tuple[list[str], list[str]]], chosen: dict[str, str], taken: dict[str, str]) -> None:
    """Add to the mapping the values that it lacks, by the majority of the pairs of item and document values.

    Ties go to the item's own value, then to the smaller one; two item values are not taken to one.
    """
    votes: dict[str, Counter] = defaultdict(Counter)
    for item, doc in pairs:
        for a, b in zip(item, doc, strict=True):
            if (a or b) and a not in chosen:
                votes[a][b] += 1
    for a, c in sorted(votes.items(), key=lambda x: (-max(x[1].values()), x[0])):
        b = min(c, key=lambda v: (-c[v], v != a, v))
        if taken.setdefault(b, a) == a:
            chosen[a] = b


def _agree(item: list[str], doc: list[str], chosen: dict[str, str]) -> bool:
    return all(a == b or chosen.get(a) == b for a, b in zip(item, doc, strict=True))


def consistent(pairs: list[tuple[int, list[str], list[str]]]) -> set[int]:
    """Item windows whose slot values agree with the majority mapping of the pairs.

    pairs: (item window, item values, document values). The mapping takes each item value to the
    document value it meets most, and must not take two item values to one; equal values always agree.
    """
    chosen: dict[str, str] = {}
    _choose([(item, doc) for _, item, doc in pairs], chosen, {})
    return {w for w, item, doc in pairs if _agree(item, doc, chosen)}


def best_occurrence(pairs: list[tuple[int, int, list[str], list[str]]], n_windows: int, least: float) -> int:
    """The most item windows that agree in one occurrence of the item.

    pairs: (item window, document place, item values, document values). Matches of one alignment (document
    place minus item place) are one run and give an occurrence's mapping; values it lacks come from the
    runs nearest to it, since words put in or left out shift the rest. The windows of the places around
    it, an item's length before and after, are counted if they agree. A mapping over the whole document
    is tried too: the parts of an item may lie far apart. Occurrences below `least` are not looked at.
    """
    best = len(consistent([(w, item, doc) for w, _, item, doc in pairs]))
    pairs = sorted(pairs, key=lambda x: x[1])
    places = [p for _, p, _, _ in pairs]
    for at in sorted({p - w for w, p, _, _ in pairs}):
        if best == n_windows:
            break
        near = pairs[bisect_left(places, at - n_windows):bisect_left(places, at + 2 * n_windows)]
        held = len({w for w, _, _, _ in near})
        if held <= best or held < least:
            continue
        chosen: dict[str, str] = {}
        taken: dict[str, str] = {}
        for _, run in groupby(sorted(near, key=lambda x: abs(x[1] - x[0] - at)), key=lambda x: abs(x[1] - x[0] - at)):
            _choose([(item, doc) for _, _, item, doc in run], chosen, taken)
        best = max(best, len({w for w, _, item, doc in near if _agree(item, doc, chosen)}))
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, similarity: float = SIMILARITY,
                 memory_windows: int = MEMORY_WINDOWS) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, share of each (document, item) with share >= similarity.

    share is the larger of two: the part of the item's template windows that the document's best occurrence of
    it holds with consistent slots, and the part of its plain windows that the document holds; n_windows and
    n_matched belong to it (the templates' if both are equal). Null and empty texts hold none and match none;
    rows with a null id take no part; items repeated with the same text match each; rows repeated with the same
    doc_id count together. An item shorter than a window is one window of its own length: its plain words are
    found inside any text, its template only matches whole texts that short.
    """
    small_batches(docs.sparkSession)
    items = materialize(_windows_of(texts(benchmark, "item_id").where("doc_id is not null"), "item_id", None, size)
                        .withColumnRenamed("at", "item_at").withColumnRenamed("slots", "item_slots"))
    sizes = items.groupBy("item_id", "kind").agg(F.count(F.lit(1)).alias("n_windows"))
    rows = texts(docs).where("doc_id is not null")
    distinct = items.select("window").distinct()
    few = distinct.limit(memory_windows + 1).count() <= memory_windows
    wanted = np.array([r["window"] for r in distinct.collect()], np.int64).view(np.uint64) if few else None
    # the lengths of items shorter than a window, at most size - 1 of them
    lengths = texts(benchmark, "item_id").where("doc_id is not null").mapInPandas(_short_lengths(size), "n int").distinct()
    hits = _windows_of(rows, "doc_id", wanted, size, tuple(sorted(r["n"] for r in lengths.collect())))
    matched = materialize(hits.join(F.broadcast(items) if few and items.count() <= memory_windows else items, ["kind", "window"])
                          .select("doc_id", "item_id", "kind", "item_at", "at", "item_slots", "slots"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        pairs: list = []

        def result() -> pd.DataFrame:
            d, i, kind, n = held
            return pd.DataFrame({"doc_id": [d], "item_id": [i], "kind": [kind], "n_matched": [
                best_occurrence(pairs, n, similarity * n) if kind == TEMPLATE else len({w for w, *_ in pairs})]})

        for b in batches:
            for d, i, kind, n, w, p, s, t in zip(b["doc_id"], b["item_id"], b["kind"], b["n_windows"], b["item_at"], b["at"],
                                                 b["item_slots"], b["slots"], strict=True):
                if (d, i, kind, n) != held:
                    if held is not None:
                        yield result()
                    held, pairs = (d, i, kind, n), []
                if len(s) == len(t):
                    pairs.append((w, p, list(s), list(t)))
        if held is not None:
            yield result()

    # pairs that hold too few different windows of the item cannot reach the share
    by = ["doc_id", "item_id", "kind"]
    enough = (matched.groupBy(*by).agg(F.countDistinct("item_at").alias("n"))
              .join(sizes, ["item_id", "kind"]).where(F.col("n") >= similarity * F.col("n_windows")).select(*by, "n_windows"))
    enough = materialize(enough)
    whole_batches(docs.sparkSession)
    checked = (matched.join(enough, by)
               .repartition(*by).sortWithinPartitions(*by, "at", "item_at")
               .mapInPandas(verify, "doc_id long, item_id long, kind byte, n_matched long"))
    found = (checked.join(enough, by).withColumn("share", F.col("n_matched") / F.col("n_windows")).where(F.col("share") >= similarity))
    best = F.max_by(F.struct("n_windows", "n_matched", "share"), F.struct("share", -F.col("kind"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.n_windows", "b.n_matched", "b.share")


def _short_lengths(size: int):
    """Numbers of words of texts that have fewer than `size`."""
    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonical = Canonical()
        for b in batches:
            n = [len(canonical.tokens(t).ids) for t in b["text"]]
            yield pd.DataFrame({"n": sorted({x for x in n if 0 < x < size})}).astype("int32")

    return lengths


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item; rows with a null doc_id stay."""
    return without(docs, contaminated(docs, benchmark).select("doc_id").distinct(), distinct_ids=False)
