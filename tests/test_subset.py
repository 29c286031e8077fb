"""Subset selection from moments against plain refits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmill.operators import select as fs
from snapmill.operators import subset
from snapmill.runtime import materialize

COLS = ["a", "b", "c", "d", "e", "flat", "twin"]
FOLDS = 3


@pytest.fixture(scope="module")
def ready(spark):
    """Two strong columns, two weak ones on very different scales, noise, a constant and a copy."""
    df = spark.range(900).select(
        (F.col("id") % FOLDS).cast("int").alias("FOLD"), F.randn(1).alias("a"), (F.randn(2) * 1e4 + 1e6).alias("b"),
        F.randn(3).alias("c"), (F.randn(4) * 1e-3).alias("d"), F.randn(5).alias("e"), F.lit(7.0).alias("flat"), F.randn(6).alias("u"))
    y = F.col("a") * 2 + (F.col("b") - 1e6) / 1e4 + F.col("c") * 0.5 + F.col("d") * 300 + F.col("u") > 0.3
    return materialize(df.withColumn("twin", F.col("a") * 3 - 1).withColumn("Y", y.cast("double")).drop("u"))


@pytest.fixture(scope="module")
def local(ready):
    return ready.toPandas()


def refit(rows, cols):
    """Intercept and coefficients by a plain solver over centred, scaled columns."""
    x = rows[cols].to_numpy()
    mean, scale = x.mean(axis=0), x.std(axis=0)
    design = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.linalg.lstsq(design, rows["Y"].to_numpy(), rcond=None)[0]
    return w, mean, scale


def plain_auc(y, s):
    positive, negative = s[y > 0.5], s[y < 0.5]
    return np.mean((positive[:, None] > negative) + 0.5 * (positive[:, None] == negative))


def plain_ap(y, s):
    order = np.argsort(-s, kind="stable")
    y = y[order]
    return float((np.cumsum(y) / np.arange(1, len(y) + 1))[y > 0.5].mean())


SCORES = {"roc_auc": plain_auc, "average_precision": plain_ap, "accuracy": lambda y, s: np.mean((s > 0.5) == (y > 0.5)),
          "neg_mean_squared_error": lambda y, s: -np.mean((y - s) ** 2),
          "r2": lambda y, s: 1 - np.mean((y - s) ** 2) / np.var(y)}


def plain_score(rows, cols, scoring):
    out = []
    for f in range(FOLDS):
        test = rows[rows.FOLD == f]
        if cols:
            w, mean, scale = refit(rows[rows.FOLD != f], cols)
            s = w[0] + (test[cols].to_numpy() - mean) / scale @ w[1:]
        else:
            s = np.full(len(test), rows[rows.FOLD != f].Y.mean())
        out.append(SCORES[scoring](test["Y"].to_numpy(), s))
    return float(np.mean(out))


def test_sweeping_twice_changes_nothing():
    a = np.cov(np.random.default_rng(0).normal(size=(5, 50)))
    assert np.allclose(subset.sweep(subset.sweep(a, 2), 2), a)


def test_swept_models_equal_refits(ready, local):
    moments = subset.fold_moments(ready, COLS, FOLDS)
    for f in (None, 0, 2):
        trainer = moments.trainer(f)
        rows = local if f is None else local[local.FOLD != f]
        for chosen in (["a"], ["a", "b"], ["a", "b", "d", "e"], ["b", "d"], ["a", "d"], ["a", "b", "e"]):
            for k in [COLS.index(c) for c in set(chosen) ^ {COLS[i] for i in trainer.inside}]:
                trainer.toggle(k)
            w, mean, scale = refit(rows, chosen)
            got = trainer.model()
            assert np.allclose(got[[1 + COLS.index(c) for c in chosen]], w[1:] / scale, rtol=1e-6)
            assert got[0] == pytest.approx(w[0] - (w[1:] / scale) @ mean, rel=1e-6, abs=1e-6)
            assert not got[[1 + COLS.index(c) for c in COLS if c not in chosen]].any()


@pytest.mark.parametrize("scoring", list(SCORES))
def test_forward_equals_plain_refits(ready, local, scoring):
    cols = ["a", "b", "c", "d", "e"]
    got = fs.fsel_forward(ready, cols, 3, fs.MOMENTS, scoring=scoring)
    chosen = []
    for size, column, score in got.trace:
        tried = {c: plain_score(local, [*chosen, c], scoring) for c in cols if c not in chosen}
        assert column == max(tried, key=lambda c: (round(tried[c], 9), c)) and score == pytest.approx(tried[column], abs=1e-9)
        chosen.append(column)
        assert size == len(chosen)
    assert got.columns == chosen


def test_backward_equals_plain_refits(ready, local):
    cols = ["a", "b", "c", "d", "e"]
    got = fs.fsel_backward(ready, cols, 2, fs.MOMENTS)
    left = list(cols)
    for size, column, score in got.trace:
        tried = {c: plain_score(local, [x for x in left if x != c], "roc_auc") for c in left}
        assert column == max(tried, key=lambda c: (round(tried[c], 9), c)) and score == pytest.approx(tried[column], abs=1e-9)
        left.remove(column)
        assert size == len(left)
    assert got.columns == left and set(left) == {"a", "b"}


def test_elimination_and_its_cross_validation(ready, local):
    cols = ["a", "b", "c", "d", "e"]
    got = fs.fsel_rfe(ready, cols, 2, fs.MOMENTS)
    left = list(cols)
    for _, column, weight in got.trace:
        w = np.abs(refit(local, left)[0][1:]) / local["Y"].std(ddof=0)
        assert column == left[int(np.argmin(w))] and weight == pytest.approx(w.min(), rel=1e-6)
        left.remove(column)
    assert got.columns == left

    def fold_score(size):
        out = []
        for f in range(FOLDS):
            train, test = local[local.FOLD != f], local[local.FOLD == f]
            kept = list(cols)
            while len(kept) > size:
                kept.pop(int(np.argmin(np.abs(refit(train, kept)[0][1:]))))
            w, mean, scale = refit(train, kept)
            out.append(plain_auc(test["Y"].to_numpy(), w[0] + (test[kept].to_numpy() - mean) / scale @ w[1:]))
        return float(np.mean(out))

    cv = fs.fsel_rfecv(ready, cols, 1, fs.MOMENTS)
    assert [t[0] for t in cv.trace] == [5, 4, 3, 2, 1]
    assert [t[2] for t in cv.trace] == pytest.approx([fold_score(s) for s in (5, 4, 3, 2, 1)], abs=1e-9)
    assert len(cv.columns) == max(cv.trace, key=lambda t: (t[2], -t[0]))[0]


def test_constant_and_repeated_columns_do_no_harm(ready):
    got = fs.fsel_forward(ready, COLS, len(COLS), fs.MOMENTS)
    assert len(got.columns) == len(COLS) and all(np.isfinite(t[2]) for t in got.trace)
    assert fs.fsel_backward(ready, COLS, 1, fs.MOMENTS).columns
    assert "flat" not in fs.fsel_rfe(ready, COLS, 3, fs.MOMENTS).columns


def test_unknown_scores_raise(ready):
    for kind in (fs.MOMENTS, "logistic"):
        with pytest.raises(ValueError):
            fs.fsel_forward(ready, ["a", "b"], 1, kind, scoring="other")


@pytest.mark.parametrize("scoring", ["roc_auc", "average_precision"])
def test_areas_from_ranges_of_scores(spark, monkeypatch, scoring):
    """Many ranges, ties over all rows, across blocks and inside them: the areas are those of the ordered rows."""
    monkeypatch.setattr(subset, "RANGE_ROWS", 40)
    monkeypatch.setattr(subset, "CUT_ROWS", 300)
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 3, 900)])
    y, fold = (x[:, 0] + rng.normal(size=900) > 0.4).astype(float), rng.integers(0, 2, 900)
    df = spark.createDataFrame([(int(f), float(v), *map(float, r)) for f, v, r in zip(fold, y, x, strict=True)],
                               "FOLD int, Y double, a double, b double").repartition(4)
    models = rng.normal(size=(3, 2, 3))
    models[1, :, 1], models[2] = 0.0, 0.0
    got = subset.score_models(df, subset.fold_moments(df, ["a", "b"], 2), models, scoring)

    def plain(m):
        out = []
        for f in range(2):
            s, t = models[m, f, 0] + x[fold == f] @ models[m, f, 1:], y[fold == f] > 0.5
            at_least = s[t][:, None] <= s[None, :]
            out.append(plain_auc(t, s) if scoring == "roc_auc" else np.mean((at_least & t).sum(axis=1) / at_least.sum(axis=1)))
        return np.mean(out)

    # a sum of doubles in another order may part equal scores; these have one varying term at most
    assert np.allclose(got, [plain(m) for m in range(3)], atol=1e-12)
