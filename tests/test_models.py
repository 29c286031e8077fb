from datetime import date, datetime

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import D, plan
from snapmill.operators import calendar as cal
from snapmill.operators import explain as ex
from snapmill.operators import model as m
from snapmill.operators import select as fs
from snapmill.operators.boosting import BLOCK, SoftmaxBoosting, _codes, _Tree, _unit
from snapmill.operators.compiled import CompiledModel, compile_model
from snapmill.plans import scoring, training
from snapmill.runtime import materialize
from snapmill.sources.store import SnapshotTable


@pytest.fixture(scope="module")
def planted(spark):
    """Customers whose conversion follows x and the group, not z."""
    u = F.rand(11)
    df = spark.range(1200).select(
        F.col("id").alias("CUST_ID"), F.lit(D).alias("SNAP_DT"), F.randn(1).alias("x"), F.randn(2).alias("z"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 2 == 0).alias("f"), u.alias("u"))
    p = 1 / (1 + F.exp(-(2 * F.col("x") + F.when(F.col("g") == "a", 1.0).otherwise(-1.0))))
    return materialize(df.withColumn("CONV_7D", (F.col("u") < p).cast("int")).drop("u"))


@pytest.fixture(scope="module")
def linear(planted):
    return training.train(planted, m.LinearParams(loss="log", max_iter=50), None, calibration="sigmoid")


def test_filter_selection_finds_the_signal(planted):
    kept = fs.fsel_filter(planted, "CONV_7D")
    assert "x" in kept and "g" in kept and "z" not in kept and "f" not in kept
    assert "x" in fs.fsel_filter(planted, "CONV_7D", fs.FilterOptions(use_mi_threshold=False, use_cluster_kbest=True))


@pytest.fixture(scope="module")
def ready(planted):
    return fs.wrapper_inputs(planted, "CONV_7D")


def test_wrappers_keep_the_signal(ready):
    frame, cols = ready
    assert fs.fsel_rfe(frame, cols, 1, "logistic").columns == ["x"]
    assert fs.fsel_forward(frame, ["x", "z"], 1, "logistic").columns == ["x"]
    assert fs.fsel_backward(frame, ["x", "z"], 1, "logistic").columns == ["x"]
    cv = fs.fsel_rfecv(frame, ["x", "z"], 1, "logistic")
    assert "x" in cv.columns and len(cv.trace) == 2
    assert fs.fsel_embedded(frame, cols, "1.25*mean", "forest").columns == ["x"]
    with pytest.raises(ValueError):
        fs.fsel_embedded(frame, cols, "3*max", "linear")
    with pytest.raises(ValueError):
        fs.learner("other", "Y")


def test_trained_model_scores_and_survives_saving(spark, planted, linear, tmp_path):
    auc = training.train_auc(training.evaluate(linear, {"train": planted}), 2).first().ROC_AUC
    assert auc > 0.8
    out = linear.score(planted, ["CUST_ID", "SNAP_DT"])
    assert out.columns == ["CUST_ID", "SNAP_DT", "PROB_CLS0", "PROB_CLS1", "CALIB_CLS0", "CALIB_CLS1"]
    assert out.where("abs(PROB_CLS0 + PROB_CLS1 - 1) > 1e-9 or abs(CALIB_CLS0 + CALIB_CLS1 - 1) > 1e-9").isEmpty()
    linear.save(str(tmp_path / "m"), spark)
    again = training.TrainedModel.load(str(tmp_path / "m"), spark).score(planted, ["CUST_ID", "SNAP_DT"])
    assert again.exceptAll(out).isEmpty()
    cal_ = cal.calendar_weeks(spark.createDataFrame([("v1", 2024, 3)], "MODEL_ID string, ISO_YEAR int, ISO_WEEK int"))
    sink = SnapshotTable(spark, str(tmp_path / "scores"))
    for _ in range(2):
        scoring.run_scoring(planted, cal_, {"v1": str(tmp_path / "m")}, sink, D)
    assert sink.count(D) == planted.count()
    with pytest.raises(ValueError):
        scoring.model_for(cal_, date(2030, 1, 1))


def test_tree_isotonic_and_permutation(spark, planted, tmp_path):
    model = training.train(planted, m.TreeParams(n_estimators=5), None, ["x", "z", "g"], calibration="isotonic")
    drops = {r.COLUMN: r.AUC_DROP for r in ex.explain_tree(
        model.model, model.prepared(planted, ["CUST_ID", "SNAP_DT", "CONV_7D"]), model.features, "CONV_7D", ["CUST_ID", "SNAP_DT"]).collect()}
    assert drops["x"] > 0.1 and drops["x"] > 5 * abs(drops["z"])
    rows = model.score(planted, ["CUST_ID"]).orderBy("PROB_CLS1").collect()
    calibrated = [r.CALIB_CLS1 for r in rows]
    assert all(a <= b + 1e-12 for a, b in zip(calibrated, calibrated[1:]))
    model.save(str(tmp_path / "t"), spark)
    back = training.TrainedModel.load(str(tmp_path / "t"), spark).score(planted, ["CUST_ID"])
    assert back.exceptAll(model.score(planted, ["CUST_ID"])).isEmpty()


def plain_pav(x, y):
    """Pool adjacent violators over distinct, ascending x."""
    blocks = []
    for a, v in zip(x, y, strict=True):
        blocks.append([v, 1, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return [v for v, _, n in blocks for _ in range(n)]


@pytest.mark.parametrize("n", [10, 100_000, 1_000_000])
def test_isotonic_equals_plain_pooling(spark, n):
    score = (F.col("id") + 0.5) / n
    rows = materialize(spark.range(n).select(
        score.alias("PROB_CLS1"), (1 - score).alias("PROB_CLS0"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0 < score).cast("int").alias("CONV_7D")))
    got = m.calib_isotonic(rows, 2, "CONV_7D").transform(rows, 2).orderBy("PROB_CLS1").toPandas()
    want = plain_pav(got["PROB_CLS1"], got["CONV_7D"])
    assert max(abs(got["CALIB_CLS1"] - want)) < 1e-9


def test_calibration_without_the_logit(planted, linear):
    scored = linear.score(planted, ["CUST_ID", "CONV_7D"]).drop("CALIB_CLS0", "CALIB_CLS1")
    with_, without = (m.calib_sigmoid(scored, 2, "CONV_7D", logit=x) for x in (True, False))
    assert without.method == "sigmoid_raw" and with_.curves != without.curves
    a, b = (c.transform(scored, 2).agg(F.avg("CALIB_CLS1")).first()[0] for c in (with_, without))
    assert a == pytest.approx(b, abs=0.02)


def test_multiclass_forest(planted):
    three = planted.withColumn("CONV_7D", F.when(F.col("x") > 0.5, 2).when(F.col("x") > -0.5, 1).otherwise(0))
    model = training.train(three, m.TreeParams("multiclass", 5, boosting_type="rf"), None, ["x", "z"])
    out = model.score(three, ["CUST_ID", "CONV_7D"])
    assert {f"CALIB_CLS{i}" for i in range(3)} <= set(out.columns)
    assert out.where("abs(CALIB_CLS0 + CALIB_CLS1 + CALIB_CLS2 - 1) > 1e-9").isEmpty()


def test_unknown_options_raise(planted):
    with pytest.raises(ValueError):
        m.tree_estimator(m.TreeParams(boosting_type="dart"))
    with pytest.raises(ValueError):
        m.linear_estimator(m.LinearParams(loss="huber"))
    with pytest.raises(ValueError):
        training.train(planted, m.LinearParams(), None, calibration="other")


def test_tuning_runs_its_trials(planted):
    model = training.train(planted, m.LinearParams(loss="log", max_iter=20), m.TuneParams(n_trials=2), ["x", "g"])
    assert len(model.trials) == 2 and max(t[2] for t in model.trials) > 0.8


def test_hinge_and_balanced_weights(planted):
    model = training.train(planted, m.LinearParams(loss="hinge", max_iter=20, class_weight="balanced"), None, ["x", "g"])
    assert training.train_auc(training.evaluate(model, {"all": planted}), 2).first().ROC_AUC > 0.8
    weights = m.assembled(planted, ["x"], "CONV_7D", balanced=True).groupBy("Y").agg(F.sum("W").alias("W")).collect()
    assert weights[0].W == pytest.approx(weights[1].W)


@pytest.mark.parametrize("params", [m.LinearParams("log", max_iter=50, class_weight="balanced"), m.TreeParams(n_estimators=3)])
def test_fits_read_equal_rows_once(planted, monkeypatch, params):
    """Rows that repeat are one weighted row for every pass; model and calibration stay those of all rows."""
    some = planted.where("CUST_ID % 20 = 0")
    copies = some.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("CUST_ID", F.col("CUST_ID") + F.col("i") * 1_000_000).drop("i")
    read, keep = [], ["x", "z", "g"]
    original = training.class_probabilities
    monkeypatch.setattr(training, "class_probabilities", lambda model, df, n: read.append(df) or original(model, df, n))
    models = [training.train(copies, params, None, keep)]
    monkeypatch.setattr(training, "foldable", lambda *_: False)
    models.append(training.train(copies, params, None, keep))
    n = some.count()
    assert read[0].count() <= 2 * n and read[0].agg(F.sum(m.ROWS)).first()[0] == 5 * n == read[1].count()
    a, b = (x.score(some, ["CUST_ID"]).orderBy("CUST_ID").toPandas() for x in models)
    assert np.allclose(a[["PROB_CLS1", "CALIB_CLS1"]], b[["PROB_CLS1", "CALIB_CLS1"]], atol=1e-4)


def test_tuning_scores_folded_rows_as_all_rows(planted):
    some = planted.where("CUST_ID % 20 = 0").select("x", F.round("z").alias("z"), F.col("CONV_7D").alias("CLASS"), (F.col("CUST_ID") % 3).cast("int").alias("FOLD"))
    rows = some.withColumn("i", F.explode(F.sequence(F.lit(0), (F.col("z") > 0).cast("int") * 3))).drop("i")
    whole = materialize(m.assembled(rows, ["x", "z"], "CLASS", ["FOLD"]))
    few = materialize(m.assembled(m.folded(rows, ["x", "z"], ["FOLD", "CLASS"]), ["x", "z"], "CLASS", ["FOLD", m.ROWS], rows=m.ROWS))
    estimator = m.linear_estimator(m.LinearParams("log", max_iter=50))
    a, b = (m.tune_group_cv(x, estimator, m.TuneParams(n_trials=2))[0] for x in (whole, few))
    assert few.count() < whole.count() and [t[2] for t in a] == pytest.approx([t[2] for t in b], abs=1e-6)


def test_label_encoding_and_coefficients(spark, linear):
    df = spark.createDataFrame([("no",), ("yes",), (None,)], "y string")
    enc = m.fit_label_encoding(df, "y")
    assert enc.classes == ["no", "yes"] and [r.c for r in m.label_encode(df, "y", enc, "c").collect()] == [0, 1, None]
    rows = m.coef_imp(linear.model, linear.features, spark).collect()
    assert rows[0].COLUMN == "INTERCEPT_" and len(rows) == len(linear.features) + 1
    with pytest.raises(TypeError):
        m.coef_imp(object(), [], spark)


def test_permutation_is_one_cycle_of_all_rows(spark):
    df = spark.range(500).repartition(7).select("id", F.lit(D).alias("d"), (F.col("id") * 3).alias("v"))
    rows = ex.permuted(df, ["v", "id"], ["id", "d"]).collect()
    onward = {r.id: r.id_PERM for r in rows}
    assert all(r.v_PERM == 3 * r.id_PERM for r in rows)
    seen, at = set(), 0
    while at not in seen:
        seen.add(at)
        at = onward[at]
    assert len(seen) == 500
    assert ex.permuted(df.limit(0), ["v"], ["id", "d"]).collect() == []


def test_auc_drop_equals_brute_force(spark, planted):
    from snapmill.functions.exprs import hash32, row_key

    model = training.train(planted, m.TreeParams(n_estimators=4), None, ["x", "z", "f"])
    keys = ["CUST_ID", "SNAP_DT"]
    data = materialize(model.prepared(planted, [*keys, "CONV_7D"]))
    got = {r.COLUMN: r.AUC_DROP for r in ex.explain_tree(model.model, data, model.features, "CONV_7D", keys).collect()}
    rows = data.withColumn("h", hash32(row_key(keys), 0)).orderBy("h", *keys).toPandas()

    def auc(frame):
        s = np.array([r.PROB_CLS1 for r in m.class_probabilities(model.model, m.assembled(
            spark.createDataFrame(frame), model.features, "CONV_7D", ["CUST_ID"]), 2).orderBy("CUST_ID").collect()])
        y = frame.sort_values("CUST_ID")["CONV_7D"].to_numpy()
        a, b = s[y == 1], s[y == 0]
        return np.mean((a[:, None] > b) + 0.5 * (a[:, None] == b))

    base = auc(rows)
    for c in model.features:
        moved = rows.copy()
        moved[c] = np.roll(rows[c].to_numpy(), -1)
        assert got[c] == pytest.approx(base - auc(moved), abs=1e-9)


KINDS = {"log": m.LinearParams(loss="log", max_iter=20), "hinge": m.LinearParams(max_iter=20), "boosted": m.TreeParams(n_estimators=6),
         "forest": m.TreeParams(n_estimators=6, boosting_type="rf")}


@pytest.mark.parametrize("kind", list(KINDS))
def test_compiled_models_equal_their_transform(planted, kind):
    model = training.train(planted, KINDS[kind], None, ["x", "z", "g", "f"])
    rows = model.prepared(planted, ["CUST_ID", "CONV_7D"])
    want = m.class_probabilities(model.model, m.assembled(rows, model.features, "CONV_7D", ["CUST_ID"]), 2).select("CUST_ID", F.col("PROB_CLS1").alias("p"))
    both = model.compiled.score(rows, ["CUST_ID"]).join(want, "CUST_ID")
    assert both.count() == 1200 and both.agg(F.max(F.abs(F.col("p") - F.col("PROB_CLS1")))).first()[0] < 1e-12
    again = CompiledModel.from_json(model.compiled.to_json())
    assert again == model.compiled
    text = plan(model.score(planted, ["CUST_ID"]))
    assert "UDF" not in text and "Python" not in text and "Exchange" not in text
    with pytest.raises(TypeError):
        compile_model(object(), [])
    # a filter on scores does not multiply the ensemble
    filtered = plan(model.score(planted, ["CUST_ID"]).where("PROB_CLS1 + CALIB_CLS1 > 0.5 and PROB_CLS0 < 0.9"))
    assert len(filtered) < 3 * len(text)


def test_compiled_softmax_equals_its_transform(planted):
    three = planted.withColumn("CONV_7D", F.when(F.col("x") > 0.5, 2).when(F.col("x") > -0.5, 1).otherwise(0))
    for params in (m.LinearParams(loss="log", max_iter=20), m.TreeParams("multiclass", 5, boosting_type="rf")):
        model = training.train(three, params, None, ["x", "z"])
        rows = model.prepared(three, ["CUST_ID", "CONV_7D"])
        want = m.class_probabilities(model.model, m.assembled(rows, model.features, "CONV_7D", ["CUST_ID"]), 3)
        both = model.compiled.score(rows, ["CUST_ID"], "Q").join(want, "CUST_ID")
        for i in range(3):
            assert both.agg(F.max(F.abs(F.col(f"Q{i}") - F.col(f"PROB_CLS{i}")))).first()[0] < 1e-12


# --- boosting of several classes

@pytest.fixture(scope="module")
def rings(spark):
    """Three classes that only depend on two columns together, with noise beside them."""
    df = spark.range(1500).select(F.col("id").alias("CUST_ID"), F.lit(D).alias("SNAP_DT"), F.randn(21).alias("x"), F.randn(22).alias("z"), F.randn(23).alias("n"))
    r = F.sqrt(F.col("x") ** 2 + F.col("z") ** 2)
    return materialize(df.withColumn("CONV_7D", F.when(r < 0.8, "in").when(r < 1.5, "mid").otherwise("out")))


def log_loss(model, df):
    coded = df.withColumn("c", model.encoding.encode(F.col("CONV_7D")))
    p = F.array(*[f"PROB_CLS{i}" for i in range(3)])
    out = model.score(coded, ["c"])
    assert out.where("abs(PROB_CLS0 + PROB_CLS1 + PROB_CLS2 - 1) > 1e-9 or abs(CALIB_CLS0 + CALIB_CLS1 + CALIB_CLS2 - 1) > 1e-9").isEmpty()
    return out.agg(F.avg(-F.log(F.greatest(F.get(p, F.col("c")), F.lit(1e-9))))).first()[0]


def test_boosting_three_classes_beats_the_forest(spark, rings, tmp_path):
    train, test = rings.where("CUST_ID % 3 > 0"), rings.where("CUST_ID % 3 = 0")
    boosted = training.train(train, m.TreeParams("multiclass", 12), None, ["x", "z", "n"])
    forest = training.train(train, m.TreeParams("multiclass", 12, boosting_type="rf"), None, ["x", "z", "n"])
    assert log_loss(boosted, test) < log_loss(forest, test)
    importance = {r.COLUMN: r.VALUE for r in m.coef_imp(boosted.model, boosted.features, spark).collect()}
    assert min(importance["x"], importance["z"]) > 5 * importance["n"]
    boosted.save(str(tmp_path / "b"), spark)
    again = training.TrainedModel.load(str(tmp_path / "b"), spark)
    assert again.score(test, ["CUST_ID"]).exceptAll(boosted.score(test, ["CUST_ID"])).isEmpty()


def test_first_boosting_round_equals_a_plain_search(rings):
    """Root split and leaf values of the first round, for each class, by brute force over the bins."""
    data = m.assembled(rings.withColumn("c", F.when(F.col("CONV_7D") == "in", 0).when(F.col("CONV_7D") == "mid", 1).otherwise(2)), ["x", "z"], "c")
    boosting = SoftmaxBoosting(3, maxIter=1, maxDepth=1, maxBins=8)
    model = boosting.fit(data)
    rows = data.toPandas()
    x, y = np.vstack([v.toArray() for v in rows["V"]]), rows["Y"].to_numpy().astype(int)
    p = np.bincount(y) / len(y)
    edges = boosting._edges(data.select(vector_to_array("V").alias("X")), 2)
    for k in range(3):
        g, h = p[k] - (y == k), np.full(len(y), p[k] * (1 - p[k]) * 1.5)
        best = max(((g[x[:, f] <= e].sum() ** 2 / (h[x[:, f] <= e].sum() + 1) + g[x[:, f] > e].sum() ** 2 / (h[x[:, f] > e].sum() + 1), -f, -e)
                    for f in range(2) for e in edges[f]))
        f, e, left, right = model.rounds[0][k]
        assert (f, e) == (-best[1], -best[2])
        here = x[:, f] <= e
        assert left[0] == pytest.approx(-0.1 * g[here].sum() / (h[here].sum() + 1)) and right[0] == pytest.approx(-0.1 * g[~here].sum() / (h[~here].sum() + 1))


def test_refreshed_margins_change_nothing(rings, monkeypatch):
    data = m.assembled(rings.withColumn("c", F.when(F.col("CONV_7D") == "in", 0).otherwise(1)), ["x", "z"], "c")
    boosting = SoftmaxBoosting(2, maxIter=3, maxDepth=1, subsamplingRate=0.7)
    whole = boosting.fit(data)
    monkeypatch.setattr("snapmill.operators.boosting.REFRESH", 2)
    parted = boosting.fit(data)
    assert str(whole.rounds)[:400] == str(parted.rounds)[:400]
    with pytest.raises(ValueError):
        SoftmaxBoosting(1).fit(data)
    with pytest.raises(ValueError):
        boosting.fit(data.limit(0))


def test_boosting_keeps_rows_in_blocks(rings):
    """Tasks read a few byte strings a block, not an object per row, and walk them to the leaves of a plain walk."""
    data = m.assembled(rings.withColumn("c", F.when(F.col("CONV_7D") == "in", 0).otherwise(1)), ["x", "z"], "c")
    boosting = SoftmaxBoosting(2, maxBins=8)
    x = data.select(vector_to_array("V").alias("X"), F.col("Y").cast("int").alias("Y"), F.col("W"))
    table = boosting._binned(x, boosting._edges(x, 2), np.zeros(2))
    blocks = table.collect()
    assert sum(b.N for b in blocks) == rings.count() and len(blocks) < 50
    tree = _Tree()
    tree.split(0, 0, 3, 1.0)
    tree.split(2, 1, 4, 1.0)
    for b in blocks:
        bins, _ = boosting._state(b, [])
        assert tree.place(bins).tolist() == [1 if u <= 3 else 3 if v <= 4 else 4 for u, v in bins.T.tolist()]


def _plain_boosting(b, y, k_all, rounds, depth, least):
    """Boosting over bins (column, row) by plain sums over the rows of every node."""
    start = np.log(np.bincount(y, minlength=k_all) / len(y))
    m, out = np.repeat(start[:, None], len(y), axis=1), []
    for _ in range(rounds):
        p = np.exp(m - m.max(axis=0))
        p /= p.sum(axis=0)
        grown = []
        for k in range(k_all):
            g, h = p[k] - (y == k), p[k] * (1 - p[k]) * k_all / (k_all - 1)

            def grow(rows, level):
                gain = lambda r: g[r].sum() ** 2 / (h[r].sum() + 1)
                best = None
                for f in range(len(b) if level < depth else 0):
                    for e in range(7):
                        left, right = rows[b[f, rows] <= e], rows[b[f, rows] > e]
                        if min(len(left), len(right)) >= least and min(h[left].sum(), h[right].sum()) >= 1e-3:
                            now = gain(left) + gain(right) - gain(rows)
                            if now > 1e-9 and (best is None or now > best[0] + 1e-9):
                                best = (now, f, e, left, right)
                if best is None:
                    v = -0.1 * g[rows].sum() / (h[rows].sum() + 1)
                    moves.append((rows, v))
                    return [v]
                return [best[1], best[2], grow(best[3], level + 1), grow(best[4], level + 1)]

            moves = []
            grown.append(grow(np.arange(len(y)), 0))
            for rows, v in moves:
                m[k, rows] += v
        out.append(grown)
    return out


@pytest.mark.parametrize("joint", [1, 1024])
def test_boosting_equals_plain_sums_and_reads_smaller_children(rings, monkeypatch, joint):
    """Trees of several levels and rounds, though a task reads one child of a split and the last level is not read."""
    data = m.assembled(rings.withColumn("c", F.when(F.col("CONV_7D") == "in", 0).when(F.col("CONV_7D") == "mid", 1).otherwise(2)), ["x", "z", "n"], "c")
    boosting = SoftmaxBoosting(3, maxIter=3, maxDepth=3, maxBins=8)
    read = []
    count = SoftmaxBoosting._count

    def counted(self, table, since, edges, n, unit, trees):
        for t in trees:
            wanted = t.to_scan(2 * self.minInstancesPerNode)
            assert wanted in ([], [0]) or all(2 * t.totals[i][2] <= t.totals[i][2] + t.totals[2 * t.left[t.parents()[i]] + 1 - i][2] for i in wanted)
        read.append(n)
        count(self, table, since, edges, n, unit, trees)

    monkeypatch.setattr(SoftmaxBoosting, "_count", counted)
    monkeypatch.setattr("snapmill.operators.boosting.JOINT_BINS", joint)
    monkeypatch.setattr("snapmill.operators.boosting.BLOCK", 100)
    model = boosting.fit(data)
    assert read == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    rows = data.toPandas()
    x, y = np.vstack([v.toArray() for v in rows["V"]]), rows["Y"].to_numpy().astype(int)
    edges = boosting._edges(data.select(vector_to_array("V").alias("X")), 3)
    b = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)])

    def same(node, plain):
        if len(plain) == 1:
            return len(node) == 1 and node[0] == pytest.approx(plain[0], abs=1e-6)
        return node[:2] == [plain[0], edges[plain[0]][plain[1]]] and same(node[2], plain[2]) and same(node[3], plain[3])

    for r, plain in zip(model.rounds, _plain_boosting(b, y, 3, 3, 3, 20), strict=True):
        assert all(same(node, want) for node, want in zip(r, plain, strict=True))


def test_bins_equal_binary_search():
    edges = np.array([-1.5, 0.0, 2.0])
    v = np.array([-np.inf, -1.5, -1.4, 0.0, -0.0, 1.0, 2.0, 2.1, np.inf, np.nan])
    assert _codes(v, edges).tolist() == np.searchsorted(edges, v, side="left").tolist()
    assert _codes(v, edges[:0]).tolist() == [0] * len(v)


def test_large_weights_leave_room_in_the_sums():
    assert _unit(1e6, 1.0) == 2.0 ** 30 == _unit(0.0, 0.0)
    total, heaviest = 1e12, 1e7
    assert total * _unit(total, heaviest) < 2.0 ** 62 and BLOCK * heaviest * _unit(total, heaviest) < 2.0 ** 52


def test_trees_are_generated_code_not_part_of_a_generator(rings):
    """What is in a generator or a higher-order function is interpreted, so the trees are not."""
    for n in (3, 70):
        tree = [0, 0.5, [0.1, 0.0], [0.0, 0.2]]
        compiled = CompiledModel("trees", "softmax", ["x"], [], [[0.5, 0.5], *[tree] * n], [1.0] * (n + 1))
        scored = compiled.score(rings, ["CUST_ID", "x"])
        text = plan(scored)
        nodes = [node for node in text.split("\n\n") if "inline(" in node]
        assert len(nodes) == 1 and "CASE WHEN" not in nodes[0] and "CASE WHEN" in text
        r = scored.withColumn("m", F.when(F.col("x") <= 0.5, 0.1 * n).otherwise(-0.2 * n))
        assert r.agg(F.max(F.abs(1 / (1 + F.exp(-F.col("m"))) - F.col("PROB_CLS0")))).first()[0] < 1e-9


def test_training_rows_are_spread_once_and_scores_grouped_once(rings, monkeypatch):
    """Rows are shuffled before the vector is made, and a calibration's scores are aggregated once."""
    spread_columns, grouped = [], []
    spread, materialize_ = training.spread, m.materialize
    monkeypatch.setattr(training, "spread", lambda df, *keys: spread_columns.append(df.columns) or spread(df, *keys))
    monkeypatch.setattr(m, "materialize", lambda df: grouped.append(df.columns) or materialize_(df))
    training.train(rings, m.TreeParams("multiclass", 1), None, ["x", "z"])
    assert spread_columns == [["CUST_ID", "SNAP_DT", "CONV_7D", "x", "z", "CLASS"]]
    assert grouped == [["S", "RATE", "N"]] * 3


def test_tuning_of_several_classes(rings):
    model = training.train(rings, m.TreeParams("multiclass", 2), m.TuneParams(n_cv=2, n_trials=2), ["x", "z"])
    assert len(model.trials) == 2 and max(t[2] for t in model.trials) > 0.7


# --- stratified folds

def test_folds_keep_entities_and_balance_classes(spark):
    rng = np.random.default_rng(4)
    rows = []
    for e in range(400):
        n = int(rng.integers(1, 9))
        rows += [(e, int(rng.random() < (0.1 if e % 3 else 0.6))) for _ in range(n)]
    rows += [(10_000, 1)] * 20 + [(None, 1)] * 3 + [(5, None)]
    df = spark.createDataFrame(rows, "e int, y int")
    folds = {r.e: r.FOLD for r in m.stratified_folds(df, "e", "y", 3).collect()}
    assert set(folds) == {e for e, _ in rows if e is not None} and set(folds.values()) == {0, 1, 2}
    for label in (0, 1):
        weight = {}
        for e, y in rows:
            if y == label and e is not None:
                weight[e] = weight.get(e, 0) + 1
        load = [sum(w for e, w in weight.items() if folds[e] == f) for f in range(3)]
        assert max(load) - min(load) <= max(weight.values()), (label, load)
    again = {r.e: r.FOLD for r in m.stratified_folds(df.repartition(13), "e", "y", 3).collect()}
    assert again == folds


def test_linear_attributions_sum_to_the_score_difference(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 6.0)], "k int, a double, b double")
    rows = {r.k: r for r in ex.explain_linear(df, {"a": 2.0, "b": -1.0}, ["k"]).collect()}
    assert (rows[1].a, rows[1].b) == (-2.0, 2.0) and rows[2].a == 2.0
    top = ex.explain_global(ex.explain_linear(df, {"a": 2.0, "b": -1.0}, ["k"]), ["a", "b"], top=1).collect()
    assert [(r.COLUMN, r.MEAN_ABS) for r in top] == [("a", 2.0)]


def test_input_validation(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "a string, b string")
    want = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert ex.input_validate(df, want).schema["a"].dataType == T.LongType()
    with pytest.raises(ValueError):
        ex.input_validate(df, T.StructType([T.StructField("zz", T.LongType())]))
    with pytest.raises(TypeError):
        ex.input_validate(df, T.StructType([T.StructField("b", T.LongType())]))


# --- calendar ---------------------------------------------------------------------------------

CAL = "MODEL_ID string, START_TS timestamp_ntz, END_TS timestamp_ntz"


def t(text):
    return datetime.fromisoformat(text)


def rows_of(df):
    return sorted((r.START_TS, r.END_TS, r.MODEL_ID) for r in df.collect())


def test_weeks(spark):
    df = spark.createDataFrame([("a", 2024, 1), ("a", 2024, 5), ("a", 2024, 52), ("b", 2026, 53)], "MODEL_ID string, ISO_YEAR int, ISO_WEEK int")
    got = {(r.START_TS.date(), (r.END_TS - r.START_TS).days) for r in cal.calendar_weeks(df).collect()}
    assert got == {(date.fromisocalendar(y, w, 1), 7) for y, w in ((2024, 1), (2024, 5), (2024, 52), (2026, 53))}


def test_put_trims_splits_and_replaces(spark):
    base = spark.createDataFrame([("a", t("2024-01-01"), t("2024-01-10")), ("b", t("2024-01-10"), t("2024-01-12")),
                                  ("c", t("2024-01-12"), t("2024-01-31"))], CAL)
    got = rows_of(cal.calendar_put(base, "n", t("2024-01-05"), t("2024-01-15")))
    assert got == [(t("2024-01-01"), t("2024-01-05"), "a"), (t("2024-01-05"), t("2024-01-15"), "n"), (t("2024-01-15"), t("2024-01-31"), "c")]
    got = rows_of(cal.calendar_put(base, "n", t("2024-01-03"), t("2024-01-04")))
    assert len(got) == 5 and all(x[1] <= y[0] for x, y in zip(got, got[1:]))
    with pytest.raises(ValueError):
        cal.calendar_put(base, "n", t("2024-01-04"), t("2024-01-04"))


def test_gapfill_and_pick(spark):
    base = spark.createDataFrame([("a", t("2024-01-01"), t("2024-01-03T06:00:00")), ("b", t("2024-01-05T06:00:00"), t("2024-01-07"))], CAL)
    assert rows_of(cal.calendar_gapfill(base, "p"))[1] == (t("2024-01-03T06:00:00"), t("2024-01-05T06:00:00"), "p")
    days = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 9)], "d date")
    got = {r.d.day: r.MODEL_ID for r in cal.model_pick(days, base, "d", "p").collect()}
    assert got == {1: "a", 2: "a", 3: "a", 4: "p", 5: "p", 6: "b", 7: "p", 8: "p"}
    with pytest.raises(Exception):
        cal.model_pick(days, base, "d").collect()


def test_registered_queries_and_checks_agree_on_names():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 110
