"""Language identification by cross-parsing entropy over suffix automata.

For every language a suffix automaton of labelled text recognises all its substrings. A text is parsed
greedily into phrases, each the longest match with the automaton; the language that needs the fewest
phrases per letter wins. Texts are cut into pieces of PIECE characters that are parsed separately (a
phrase never crosses a cut), so pieces of all texts and all languages advance together, one vectorised
table lookup per character.

An automaton is fitted per language on at most SAMPLE_CHARS characters of its labelled texts (those
with the smallest hash); the tables are bounded by languages x SAMPLE_CHARS whatever the corpus. All characters
of the samples are symbols: moves of the COMMON most frequent ones are a dense table, those of all others,
as in scripts of many letters, an ordered list of (state, symbol) that is searched.
Prediction is one scan without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.llm.common import fold, small_batches, texts
from snapmill.runtime import collect_bounded

SAMPLE_CHARS = 24_000
SAMPLE_ROWS = 60
ROW_CHARS = 4_000
MAX_LANGUAGES = 200
COMMON = 96
SHIFT = 21  # bits of a code point
PIECE = 256
SPACE = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Lower-cased letters; everything between them is one space."""
    return SPACE.sub(" ", text.lower()).strip()


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of the symbols; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


@dataclass(frozen=True)
class Model:
    """Languages, the alphabet, and the moves of all automata.

    A state is its row's start in the dense table; a move is the next state times two, plus one if a phrase
    ends. Symbols from `size` on are looked up in `rare`, ascending keys state << SHIFT | symbol, with their
    `rare_moves`; one that is missing ends the phrase and starts the next from the root, or is a phrase of
    its own, after which the language's `lost` state begins anew.
    """

    languages: list[str]
    codes: np.ndarray
    size: int
    table: np.ndarray
    roots: np.ndarray
    lost: np.ndarray
    rare: np.ndarray
    rare_moves: np.ndarray

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text; 0 for a character that no language's sample holds."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        return self.codes[np.minimum(points, len(self.codes) - 1)]

    def _found(self, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (state.astype(np.int64) << SHIFT) | c
        at = np.minimum(np.searchsorted(self.rare, key), max(len(self.rare) - 1, 0))
        return self.rare[at] == key, self.rare_moves[at]

    def _rare_moves(self, state: np.ndarray, c: np.ndarray, language: int) -> np.ndarray:
        there, move = self._found(state, c)
        root, lost = self.roots[language], self.lost[language]
        begins, start = self._found(np.full(len(c), root), c)
        # from the root a phrase begins but none ends
        anew = np.where(begins, start, lost << 1) | (state != root)
        return np.where(there, move, anew).astype(np.int32)

    def phrases(self, batch: list[str]) -> np.ndarray:
        """Phrases needed by each text in each language."""
        pieces, owner = [], []
        for i, text in enumerate(batch):
            s = self.symbols(text)
            for at in range(0, len(s), PIECE):
                pieces.append(s[at:at + PIECE])
                owner.append(i)
        out = np.zeros((len(batch), len(self.languages)))
        if not pieces:
            return out
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((PIECE, len(pieces)), np.int32)
        for column, k in enumerate(order.tolist()):
            grid[:lengths[k], column] = pieces[k]
        alive = len(pieces) - np.searchsorted(np.sort(lengths), np.arange(PIECE), side="right")
        # places of rare symbols, step by step; few texts have any
        rare = [np.flatnonzero(grid[step] >= self.size) for step in range(PIECE)] if (grid >= self.size).any() else None
        for k, root in enumerate(self.roots.tolist()):
            state = np.full(len(pieces), root, np.int32)
            ends = np.ones(len(pieces), np.int32)
            for step in range(int(lengths.max())):
                n = alive[step]
                if rare is None or not len(rare[step]):
                    move = self.table[state[:n] + grid[step, :n]]
                else:
                    c, at = grid[step, :n], rare[step]
                    move = self.table[state[:n] + np.where(c < self.size, c, 0)]
                    move[at] = self._rare_moves(state[at], c[at], k)
                ends[:n] += move & 1
                state[:n] = move >> 1
            out[:, k] = np.bincount(np.asarray(owner)[order], weights=ends, minlength=len(batch))
        return out


def build(samples: dict[str, str]) -> Model:
    """The model of the languages' sample texts (already normalised)."""
    joined = "".join(samples.values())
    points, counts = np.unique(np.frombuffer(joined.encode("utf-32-le"), np.uint32), return_counts=True)
    # symbol 0 is any other character; the most frequent ones come next
    codes = np.zeros(int(points.max(initial=0)) + 2, np.int32)
    codes[points[np.argsort(-counts, kind="stable")]] = np.arange(1, len(points) + 1)
    size, parts, roots, lost, keys, moves, at = min(len(points) + 1, COMMON), [], [], [], [], [], 0
    for text in samples.values():
        spelled = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        edges = automaton(codes[spelled].tolist())
        t = np.full((len(edges) + 1, size), -1, np.int32)
        for s, found in enumerate(edges):
            for c, to in found.items():
                if c < size:
                    t[s, c] = to
                else:
                    keys.append(((s * size + at) << SHIFT) | c)
                    moves.append((to * size + at) << 1)
        # where nothing follows, the phrase ends and the symbol starts the next one at the root; a symbol that
        # the language lacks is a phrase of its own, after which (in the state added last) any symbol starts one
        restart = np.where(t[0] >= 0, t[0], len(t) - 1)
        ended = t < 0
        ended[0] = False  # the root is only met at the start, where a phrase begins but none ends
        t[0] = restart
        t = (np.where(ended, restart[None, :], t).astype(np.int64) * size + at) * 2 + ended
        parts.append(t.astype(np.int32).ravel())
        roots.append(at)
        lost.append(at + (len(edges) * size))
        at += len(parts[-1])
    if at >= 1 << 30:
        raise ValueError("the automata do not fit their table: use a smaller sample")
    # one key that no state has, so that a search never meets an empty list
    rare, rare_moves = np.array([*keys, -1], np.int64), np.array([*moves, 0], np.int64)
    order = np.argsort(rare)
    return Model(list(samples), codes, size, np.concatenate(parts), np.array(roots), np.array(lost), rare[order], rare_moves[order])


def fit(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, modulus: int = 4, held: int = 2) -> Model | None:
    """Learn from the texts and non-null languages outside the held-out fold; None if there are none."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), modulus) != held))
    # texts of usual length first, by hash; keys are ranked without their texts, which a second scan fetches
    odd = (F.length("text") > ROW_CHARS) | (F.length("text") < 40)
    first = Window.partitionBy("lang").orderBy("odd", "mark")
    keys = (rows.select("lang", odd.alias("odd"), F.xxhash64("text").alias("mark")).distinct()
            .withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_ROWS))
    picked = collect_bounded(keys, MAX_LANGUAGES * SAMPLE_ROWS, "languages")
    order = {(r.lang, r.mark): r.place for r in picked}
    found = (rows.where(F.xxhash64("text").isin(sorted({r.mark for r in picked})))
             .select("lang", F.xxhash64("text").alias("mark"), F.substring("text", 1, sample_chars).alias("text"))
             .groupBy("lang", "mark").agg(F.min("text").alias("text")))
    found = [(r.lang, order[r.lang, r.mark], r.text) for r in collect_bounded(found, len(picked) + SAMPLE_ROWS, "samples")
             if (r.lang, r.mark) in order]
    samples: dict[str, list[str]] = {}
    for name, _, text in sorted(found):
        samples.setdefault(name, []).append(normal(text))
    whole = {k: " ".join(dict.fromkeys(v))[:sample_chars] for k, v in samples.items()}
    whole = {k: v for k, v in whole.items() if v}
    return build(whole) if whole else None


def language(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs.

    A null text or one without a letter is `und` with score 0, as is every text if nothing is labelled.
    The score is how far the winner's phrase count lies below the runner-up's (1 with one language);
    ties go to the language that sorts first. A null doc_id is kept, repeated rows are treated each.
    """
    model = fit(docs, modulus=modulus, held=held)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            plain = [normal(t) for t in b["text"]]
            if model is None:
                names, score = ["und"] * len(b), [0.0] * len(b)
            else:
                need = model.phrases(plain)
                best = need.argmin(axis=1)
                two = np.sort(need, axis=1)
                score = 1.0 - two[:, 0] / np.maximum(two[:, 1], 1.0) if need.shape[1] > 1 else np.ones(len(b))
                empty = np.array([not any(map(str.isalpha, t)) for t in plain], bool)
                names = [("und" if e else model.languages[k]) for k, e in zip(best, empty, strict=True)]
                score = np.where(empty, 0.0, np.clip(score, 0.0, 1.0))
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "lang_pred": names, "score": score})

    rows = texts(docs).withColumn("held_out", fold(F.col("doc_id"), modulus) == held)
    return rows.mapInPandas(predict, "doc_id long, held_out boolean, lang_pred string, score double")
