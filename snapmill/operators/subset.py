"""Subset selection from fold-wise moments: every candidate subset is a sub-matrix, not a fit.

One scan sums the products of (1, columns, label) per fold. A least-squares discriminant of any subset of the
columns, trained on all folds but one, is then read from the difference of two small matrices by the sweep
operator: sweeping a column in adds it to the model, sweeping it again takes it out. Squared-error scores
follow from the same matrices; accuracy, ROC-AUC and average precision of all candidates of a step come from
further scans, in which a block of rows meets the matrix of all candidates' coefficients. For the two areas a block
sends its distinct scores per candidate, fold and range of scores as arrays with their counts, not as rows; a range
is ordered in one task, and its place in the whole order follows from the counts of the ranges above it.

Matrices are columns x columns and live on the driver; rows never do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.runtime import collect_bounded

TOLERANCE = 1e-9
MOMENT_SCORES = ("r2", "neg_mean_squared_error")
ROW_SCORES = ("accuracy", "roc_auc", "average_precision")
# about so many rows of a fold are ordered in one task
RANGE_ROWS = 250_000
# the cuts between the ranges come from about so many rows; they change who orders a score, not the result
CUT_ROWS = 100_000


def sweep(a: np.ndarray, k: int) -> np.ndarray:
    """a with row and column k swept; twice gives a again."""
    d = a[k, k]
    out = a - np.outer(a[:, k], a[k, :]) / d
    out[k, :] = a[k, :] / d
    out[:, k] = -a[:, k] / d
    out[k, k] = 1.0 / d
    return out


@dataclass
class FoldMoments:
    """Sums of products of (1, columns, label) per fold, with columns moved by `shift`."""

    cols: list[str]
    shift: np.ndarray
    sums: np.ndarray

    @property
    def folds(self) -> int:
        return len(self.sums)

    def without(self, fold: int | None) -> np.ndarray:
        return self.sums.sum(axis=0) - (0.0 if fold is None else self.sums[fold])

    def trainer(self, fold: int | None) -> Trainer:
        return Trainer(self.without(fold), self.shift)


class Trainer:
    """Least-squares models of column subsets from one moment matrix, kept centred, scaled and swept."""

    def __init__(self, sums: np.ndarray, shift: np.ndarray) -> None:
        n = max(sums[0, 0], 1.0)
        self.means = sums[0, 1:] / n
        self.a = (sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:]) / n)
        self.spread = np.sqrt(np.maximum(np.diag(self.a), 0.0))
        self.spread[self.spread <= TOLERANCE * np.sqrt(np.maximum(np.diag(sums)[1:], 1e-300))] = 0.0
        scale = np.where(self.spread > 0, self.spread, 1.0)
        self.a = self.a / np.outer(scale, scale)
        self.scale, self.shift = scale, shift
        self.inside: list[int] = []

    def usable(self, k: int) -> bool:
        """A column without spread, or one that the model's columns already determine, gets no coefficient."""
        return self.spread[k] > 0 and self.a[k, k] > TOLERANCE

    def _weights(self, a: np.ndarray, inside: list[int]) -> np.ndarray:
        """(intercept, coefficients) on the original scale."""
        p = len(a) - 1
        out = np.zeros(p + 1)
        out[1 + np.array(inside, int)] = a[inside, p] * self.scale[p] / self.scale[inside] if inside else 0.0
        out[0] = self.means[p] - float(out[1:] @ (self.means[:p] + self.shift))
        return out

    def model(self) -> np.ndarray:
        return self._weights(self.a, self.inside)

    def toggled(self, k: int) -> np.ndarray:
        """The model with column k taken in, or out if it is in; the trainer stays as it is."""
        if k in self.inside:
            return self._weights(sweep(self.a, k), [i for i in self.inside if i != k])
        return self._weights(sweep(self.a, k), [*self.inside, k]) if self.usable(k) else self.model()

    def toggle(self, k: int) -> None:
        if k in self.inside:
            self.a = sweep(self.a, k)
            self.inside.remove(k)
        elif self.usable(k):
            self.a = sweep(self.a, k)
            self.inside.append(k)

    def importance(self, k: int) -> float:
        """Absolute standardised coefficient."""
        return abs(float(self.a[k, -1])) if k in self.inside else 0.0


def fold_moments(ready: DataFrame, cols: list[str], folds: int, label: str = "Y", fold: str = "FOLD") -> FoldMoments:
    """The moments of every fold, from one scan with partial sums per task."""
    start = ready.select(*cols).first()
    if start is None:
        raise ValueError("no rows to select features from")
    # products around some row's values do not cancel like those around zero
    shift = np.array([float(v) for v in start])
    width = len(cols) + 2
    rows, columns = np.triu_indices(width)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((folds, width, width))
        for batch in batches:
            f = batch[fold].to_numpy()
            x = np.column_stack((np.ones(len(batch)), batch[cols].to_numpy(float) - shift, batch[label].to_numpy(float)))
            for i in range(folds):
                part = x[f == i]
                sums[i] += part.T @ part
        for i in range(folds):
            yield pd.DataFrame({"F": i, "I": rows, "J": columns, "V": sums[i][rows, columns]})

    cells = (ready.select(fold, label, *cols).mapInPandas(partial, "F int, I int, J int, V double")
             .groupBy("F", "I", "J").agg(F.sum("V").alias("V")))
    sums = np.zeros((folds, width, width))
    for r in collect_bounded(cells, folds * len(rows), "moments"):
        sums[r.F, r.I, r.J] = sums[r.F, r.J, r.I] = r.V
    return FoldMoments(cols, shift, sums)


def score_models(ready: DataFrame, moments: FoldMoments, models: np.ndarray, scoring: str, label: str = "Y",
                 fold: str = "FOLD") -> np.ndarray:
    """Mean score over the folds of each model; models[m, f] is scored on the rows of fold f.

    A fold in which a score is not defined (no rows, one class) does not count.
    """
    if scoring in MOMENT_SCORES:
        return np.array([_mean([_moment_score(moments, m[f], f, scoring) for f in range(moments.folds)]) for m in models])
    if scoring not in ROW_SCORES:
        raise ValueError(f"scoring must be one of {(*ROW_SCORES, *MOMENT_SCORES)}")
    cols, count = moments.cols, len(models)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for batch in batches:
            f = batch[fold].to_numpy()
            x = np.column_stack((np.ones(len(batch)), batch[cols].to_numpy(float)))
            y = batch[label].to_numpy(float)
            for i in np.unique(f):
                yield int(i), y[f == i], x[f == i] @ models[:, i].T

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((moments.folds, count), np.int64)
        rows = np.zeros(moments.folds, np.int64)
        for i, y, s in scored(batches):
            total[i] += ((s > 0.5) == (y > 0.5)[:, None]).sum(axis=0)
            rows[i] += len(y)
        i, m = np.indices(total.shape).reshape(2, -1)
        yield pd.DataFrame({"M": m, "FOLD": i, "HITS": total.ravel(), "N": rows[i]})

    rows = ready.select(fold, label, *cols)
    if scoring == "accuracy":
        out = (rows.mapInPandas(hits, "M int, FOLD int, HITS long, N long").groupBy("M", "FOLD")
               .agg(F.try_divide(F.sum("HITS"), F.sum("N")).alias("S")))
    else:
        return np.array([_mean(a) for a in _areas(rows, moments, scored, count, scoring)])
    found: list[list[float]] = [[] for _ in range(count)]
    for r in collect_bounded(out.select("M", "FOLD", "S"), count * moments.folds, "candidate scores"):
        if r.S is not None:
            found[r.M].append(r.S)
    return np.array([_mean(s) for s in found])


def _areas(rows: DataFrame, moments: FoldMoments, scored, count: int, scoring: str) -> list[list[float]]:
    """Per model the area (ROC or average precision) in every fold where it is defined, exact with ties."""
    largest = max(float(m[0, 0]) for m in moments.sums)
    parts = max(1, -(-int(largest) // RANGE_ROWS))
    cuts = _cuts(rows, moments, scored, count, parts) if parts > 1 else {}

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
        for i, y, s in scored(batches):
            for m in range(count):
                v, at = np.unique(s[:, m], return_inverse=True)
                p = np.bincount(at, y > 0.5, len(v)).astype("<i4")
                n = np.bincount(at, y <= 0.5, len(v)).astype("<i4")
                ends = [0, *np.searchsorted(v, cuts.get((m, i), [])), len(v)]
                for part, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                    if a < b:
                        yield m, i, part, v[a:b], p[a:b], n[a:b]

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for m, i, part, _, p, n in ranges(batches):
            sums[m, i, part] = sums.get((m, i, part), 0) + np.array([p.sum(), n.sum()], np.int64)
        keys = np.array(list(sums), np.int64).reshape(-1, 3).T
        values = np.array(list(sums.values()), np.int64).reshape(-1, 2).T
        yield pd.DataFrame(dict(zip(("M", "FOLD", "PART", "P", "N"), (*keys, *values), strict=True)))

    cells = (rows.mapInPandas(totals, "M int, FOLD int, PART int, P long, N long").groupBy("M", "FOLD", "PART")
             .agg(F.sum("P").alias("P"), F.sum("N").alias("N")))
    above: dict[tuple[int, int, int], tuple[int, int]] = {}
    whole: dict[tuple[int, int], tuple[int, int]] = {}
    for r in sorted(collect_bounded(cells, count * moments.folds * parts, "ranges of scores"), key=lambda r: -r.PART):
        p, n = whole.get((r.M, r.FOLD), (0, 0))
        above[r.M, r.FOLD, r.PART] = (p, n)
        whole[r.M, r.FOLD] = (p + r.P, n + r.N)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(m, i, part, v.tobytes(), p.tobytes(), n.tobytes()) for m, i, part, v, p, n in ranges([b])]
            yield pd.DataFrame(found, columns=["M", "FOLD", "PART", "V", "P", "N"])

    def ordered(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        m, i, part = (int(k) for k in key)
        v, at = np.unique(np.frombuffer(b"".join(group["V"]), float), return_inverse=True)
        p, n = (np.bincount(at, np.frombuffer(b"".join(group[c]), "<i4"), len(v))[::-1] for c in ("P", "N"))
        tp, fp = above[m, i, part]
        positives, negatives = whole[m, i]
        if scoring == "roc_auc":
            area = float(np.sum(p * (negatives - fp - np.cumsum(n) + n / 2.0)))
        else:
            hits = tp + np.cumsum(p)
            area = float(np.sum(p * (hits / (hits + fp + np.cumsum(n)))))
        return pd.DataFrame({"M": [m], "FOLD": [i], "PART": [part], "AREA": [area]})

    areas = (rows.mapInPandas(packed, "M int, FOLD int, PART int, V binary, P binary, N binary").groupBy("M", "FOLD", "PART")
             .applyInPandas(ordered, "M int, FOLD int, PART int, AREA double"))
    sums: dict[tuple[int, int], float] = {}
    for r in sorted(collect_bounded(areas, count * moments.folds * parts, "areas of ranges")):
        sums[r.M, r.FOLD] = sums.get((r.M, r.FOLD), 0.0) + r.AREA
    found: list[list[float]] = [[] for _ in range(count)]
    for (m, i), area in sums.items():
        positives, negatives = whole[m, i]
        pairs = positives * negatives if scoring == "roc_auc" else positives
        if pairs:
            found[m].append(area / pairs)
    return found


def _cuts(rows: DataFrame, moments: FoldMoments, scored, count: int, parts: int) -> dict[tuple[int, int], list[float]]:
    """For each model and fold, scores that part its rows into about equal ranges."""
    share = CUT_ROWS / sum(float(m[0, 0]) for m in moments.sums)
    points = np.linspace(0.0, 1.0, 4 * parts + 1)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i, _, s in scored(batches):
            q = np.quantile(s, points, axis=0)
            yield pd.DataFrame({"M": np.repeat(np.arange(count), len(points)), "FOLD": i, "S": q.T.ravel()})

    sampled = rows if share >= 1.0 else rows.sample(share, seed=0)
    found = sampled.mapInPandas(sketch, "M int, FOLD int, S double").groupBy("M", "FOLD").agg(
        F.percentile_approx("S", [i / parts for i in range(1, parts)], 10 * parts).alias("CUTS"))
    return {(r.M, r.FOLD): sorted(r.CUTS) for r in collect_bounded(found, count * moments.folds, "cuts")}


def _mean(scores: list[float]) -> float:
    known = [s for s in scores if s == s]
    return sum(known) / len(known) if known else float("-inf")


def _moment_score(moments: FoldMoments, model: np.ndarray, fold: int, scoring: str) -> float:
    sums = moments.sums[fold]
    n = sums[0, 0]
    if not n:
        return float("nan")
    # the residual is a combination of (1, shifted columns, label)
    v = np.concatenate(([-(model[0] + model[1:] @ moments.shift)], -model[1:], [1.0]))
    residual = float(v @ sums @ v)
    if scoring == "neg_mean_squared_error":
        return -residual / n
    total = sums[-1, -1] - sums[0, -1] ** 2 / n
    return 1.0 - residual / total if total > 0 else float("nan")


def sequential(ready: DataFrame, cols: list[str], n: int, folds: int, scoring: str, forward: bool) -> tuple[list[str], list[tuple[int, str, float]]]:
    """(chosen columns, trace): one column is taken in (or out) a step, the one with the best mean score.

    Ties go to the later name. All candidates of a step share one scan, or none with a squared-error score.
    """
    moments = fold_moments(ready, cols, folds)
    trainers = [moments.trainer(f) for f in range(folds)]
    chosen = [] if forward else list(cols)
    if not forward:
        for t in trainers:
            for k in range(len(cols)):
                t.toggle(k)
    trace = []
    while len(chosen) < n if forward else len(chosen) > n:
        candidates = [c for c in cols if c not in chosen] if forward else list(chosen)
        at = [cols.index(c) for c in candidates]
        # a column that a fold left out when all went in changes nothing there when it goes
        models = np.array([[t.toggled(k) if forward or k in t.inside else t.model() for t in trainers] for k in at])
        scores = score_models(ready, moments, models, scoring)
        best = max(range(len(at)), key=lambda i: (scores[i], candidates[i]))
        for t in trainers:
            if forward or at[best] in t.inside:
                t.toggle(at[best])
        chosen = [*chosen, candidates[best]] if forward else [c for c in chosen if c != candidates[best]]
        trace.append((len(chosen), candidates[best], float(scores[best])))
    return chosen, trace


def eliminate(trainer: Trainer, cols: list[str], n: int) -> tuple[list[str], list[tuple[int, str, float]], list[np.ndarray]]:
    """(left columns, trace, models of every size from all to n): the least standardised coefficient goes."""
    left, trace = list(cols), []
    for k in range(len(cols)):
        trainer.toggle(k)
    models = [trainer.model()]
    while len(left) > n:
        worst = min(left, key=lambda c: (trainer.importance(cols.index(c)), c))
        trace.append((len(left), worst, trainer.importance(cols.index(worst))))
        left.remove(worst)
        if cols.index(worst) in trainer.inside:
            trainer.toggle(cols.index(worst))
        models.append(trainer.model())
    return left, trace, models


def eliminate_cv(ready: DataFrame, cols: list[str], least: int, folds: int, scoring: str) -> tuple[list[str], list[tuple[int, str, float]]]:
    """(chosen columns, trace): each fold eliminates on its own training part, the size with the best mean
    score is taken (the smaller of equals), and the columns are those left at that size on all rows."""
    moments = fold_moments(ready, cols, folds)
    per_fold = [eliminate(moments.trainer(f), cols, least)[2] for f in range(folds)]
    models = np.array([[m[i] for m in per_fold] for i in range(len(per_fold[0]))])
    scores = score_models(ready, moments, models, scoring)
    sizes = list(range(len(cols), len(cols) - len(models), -1))
    best = max(range(len(sizes)), key=lambda i: (scores[i], -sizes[i]))
    gone = eliminate(moments.trainer(None), cols, least)[1]
    trace = [(size, gone[i][1] if i < len(gone) else "", float(scores[i])) for i, size in enumerate(sizes)]
    out = {c for _, c, _ in gone[:best]}
    return [c for c in cols if c not in out], trace
