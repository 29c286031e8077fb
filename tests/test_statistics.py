import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF, plan
from snapmill.operators import evaluate as ev
from snapmill.operators import prep
from snapmill.operators import profile as p
from snapmill.operators import ranked
from snapmill.operators import select as fs
from snapmill.runtime import lookup_join
from snapmill.sources.bindings import table


# --- ranked sums and quantiles ----------------------------------------------------------------

def test_running_sums_equal_a_global_window(spark):
    rnd = random.Random(1)
    rows = [(g, v, rnd.randint(0, 5)) for g in "ab" for v in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, n long")
    for desc in (False, True):
        got = {(r.g, r.v): (r.CUM_n, r.TOTAL_n) for r in ranked.running_sums(df, ["g"], "v", ["n"], desc).collect()}
        for g in "ab":
            total, seen = sum(n for x, _, n in rows if x == g), 0
            for _, v, n in sorted((r for r in rows if r[0] == g), key=lambda r: -r[1] if desc else r[1]):
                seen += n
                assert got[g, v] == (seen, total)


def test_running_sums_have_no_single_task_window(spark):
    df = spark.range(1000).select(F.col("id").alias("v"), F.lit(1).cast("long").alias("n"))
    text = plan(ranked.running_sums(df, [], "v", ["n"]))
    # only the table of parts is ordered in one task; the rows are partitioned by their part
    assert "hashpartitioning(_PART" in text and "PythonUDF" not in text


@pytest.mark.parametrize("bracket_values,accuracy", [(200_000, 10_000), (5, 100)])
def test_exact_quantiles_equal_numpy(spark, bracket_values, accuracy):
    rnd = random.Random(2)
    smooth = [rnd.gauss(0, 1) for _ in range(3000)]
    hot = [0.0 if rnd.random() < 0.5 else rnd.random() for _ in range(3000)]
    few = [float(rnd.randint(1, 4)) for _ in range(3000)]
    holes = [None if rnd.random() < 0.3 else rnd.random() for _ in range(3000)]
    df = spark.createDataFrame(list(zip(smooth, hot, few, holes)), "smooth double, hot double, few double, holes double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ranked.exact_quantiles(df, df.columns, probs, bracket_values, accuracy)
    for name, values in (("smooth", smooth), ("hot", hot), ("few", few), ("holes", [h for h in holes if h is not None])):
        assert np.allclose([got[name][q] for q in probs], np.quantile(values, probs), rtol=1e-12, atol=1e-15)


def test_exact_quantiles_of_empty_and_infinite_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, math.inf), (None, -math.inf)], "a double, b double")
    got = ranked.exact_quantiles(df, ["a", "b"], [0.0, 0.5, 1.0])
    assert got["a"] == {0.0: None, 0.5: None, 1.0: None} and got["b"] == {0.0: -math.inf, 0.5: 1.0, 1.0: math.inf}


def test_lookup_join_beyond_the_bound_is_not_broadcast(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    small = df.withColumn("v", F.col("k") * 2)
    assert "Broadcast" in plan(lookup_join(df, small, ["k"]))
    out = lookup_join(df, small, ["k"], max_rows=10)
    assert "SortMergeJoin" in plan(out) and out.where("v = k * 2").count() == 100


# --- profile ----------------------------------------------------------------------------------

def test_numeric_profile(spark):
    values = [0.0, 0.0, 1.0, 2.0, 3.0, None, math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = {r.STAT: r.VALUE for r in p.eda_numeric(df, ["x"]).collect()}
    assert (out["TOTAL"], out["MISSING"], out["ZEROS"], out["INFS_POS"], out["INFS_NEG"]) == (9, 2, 2, 1, 1)
    assert (out["MIN"], out["MAX"], out["P50"], out["MEAN"]) == (0.0, 3.0, 1.0, 1.2)
    assert sum(out[f"HIST_{i:02d}"] for i in range(p.N_BINS)) == 5 and out["HIST_19"] == 1 and out["HIST_00"] == 2


def test_numeric_profile_extremes_and_constant(spark):
    df = spark.createDataFrame([(5.0, 0.0)] * 99 + [(5.0, 100.0)], "c double, x double")
    rows = p.eda_numeric(df, ["c", "x"]).collect()
    out = {(r.COLUMN, r.STAT): r.VALUE for r in rows}
    assert out["c", "HIST_00"] == 100 and out["c", "XTREME"] == 0
    assert (out["x", "XTREME_HIGH"], out["x", "XTREME_HIGH_MEAN"], out["x", "XTREME_LOW"]) == (1, 100.0, 0)


def test_binary_nominal_ordinal(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,), ("Y",)], "v string")
    assert {r.STAT: r.VALUE for r in p.eda_binary(df, ["v"]).collect()} == {"TOTAL": 4, "MISSING": 1, "COUNT:1": 2, "COUNT:0": 1}
    out = {r.STAT: (r.VALUE, r.POSITION) for r in p.eda_ordinal(df, "v", ["N"]).collect()}
    assert out == {"TOTAL": (4, None), "MISSING": (1, None), "COUNT:Y": (2, -1), "COUNT:N": (1, 0)}


def test_guess_dtype(spark):
    df = spark.createDataFrame([(True, "a", 1, i, 1.0 if i % 2 else 2.0, str(i)) for i in range(10)],
                               "b boolean, two string, one int, many int, bin double, s string")
    df = df.withColumn("two", F.when(F.col("many") > 4, "x").otherwise(F.when(F.col("many") > 2, "y")))
    df = df.withColumn("few", F.col("many") % 3).withColumn("d", F.current_date())
    assert {r.COLUMN: r.DTYPE for r in p.guess_dtype(df).collect()} == {
        "b": "Binary", "two": "Binary", "one": "Ordinal", "many": "Numeric", "bin": "Binary", "s": "Nominal",
        "few": "Ordinal", "d": "Nominal"}


def test_profile_is_saved_replaced_and_rejects_unknown_types(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    one = p.profile_table(df, {"c": {"dtype": "Nominal"}})
    two = p.profile_table(df, {"x": {"dtype": "Numeric", "attr": {"log_scale": True}}})
    for profile in (one, two):
        p.save_profile(profile, str(tmp_path), "7")
    back = p.load_profile(spark, str(tmp_path), "7")
    assert {r.COLUMN for r in back.select("COLUMN").distinct().collect()} == {"x", "LOG:x"}
    with pytest.raises(ValueError):
        p.profile_table(df, {"x": {"dtype": "Odd"}})


# --- preprocessing ----------------------------------------------------------------------------

def test_chain_by_type(spark):
    rows = [(i, i % 2 == 0 if i else None, float(i) if i != 3 else None, f"v{i % 12}" if i != 5 else None, i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "CUST_ID long, f boolean, x double, t string, CONV_7D int")
    fitted = prep.fit_by_dtype(df)
    out = fitted.transform(df, ["CUST_ID"])
    assert out.columns == ["CUST_ID", *fitted.outputs()] and len(fitted.columns["t"].categories) == 10
    r = {x.CUST_ID: x for x in out.collect()}
    assert (r[0].f, r[0].f_MISSING, r[1].f, r[2].f) == (-1, 1, 0, 1)
    assert all(sum(x[f"t_{c}"] for c in fitted.columns["t"].categories) == 1 for x in r.values())
    xs = np.array([float(i) for i in range(240) if i != 3])
    lo, hi = np.quantile(xs, [0.01, 0.99])
    filled = np.array([min(max(float(i), lo), hi) if i != 3 else np.median(xs) for i in range(240)])
    want = (filled - filled.mean()) / filled.std()
    assert np.allclose([r[i].x for i in range(240)], want)
    again = prep.TablePrep.from_json(fitted.to_json()).transform(df, ["CUST_ID"])
    assert again.exceptAll(out).isEmpty()
    assert "Join" not in plan(out) and "PythonUDF" not in plan(out) and "EvalPython" not in plan(out)


def test_chain_from_profile_agrees_on_clipping_and_categories(spark):
    df = table(spark, SF, "orders").withColumn("open", F.col("o_orderstatus") == "O")
    profile = p.profile_table(df, {"o_totalprice": {"dtype": "Numeric"}, "o_orderstatus": {"dtype": "Nominal"}, "open": {"dtype": "Binary"}})
    mine = prep.prep_from_profile(profile)
    other = prep.fit_by_kind(df, {"o_totalprice": "numeric", "o_orderstatus": "text", "open": "binary"})
    assert mine.columns["o_totalprice"].clip == pytest.approx(other.columns["o_totalprice"].clip)
    assert mine.columns["o_orderstatus"].categories == other.columns["o_orderstatus"].categories
    assert sorted(mine.outputs()) == sorted(other.outputs())


def test_encoders_handle_unknown_and_missing(spark):
    fit = spark.createDataFrame([("a", 1), ("b", 0), ("b", 1), (None, 0)], "c string, y int")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz"), (4, None)], "k int, c string")
    codes = {r.k: r.c_CODE for r in prep.enc_ordinal(new, "c", prep.fit_ordinal(fit, "c")).collect()}
    assert codes == {1: 1, 2: 2, 3: -1, 4: -2}
    woe = {r.k: r.c_WOE for r in prep.enc_woe(new, "c", prep.fit_woe(fit, "c", "y")).collect()}
    assert woe[1] == pytest.approx(math.log((2 / 4) / (1 / 4))) and woe[3] == 0.0
    assert woe[4] == pytest.approx(math.log((1 / 4) / (2 / 4))) and woe[2] == pytest.approx(0.0)


def test_constant_column_has_scale_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.x for r in prep.prep_standardize(df, prep.fit_standardize(df, ["x"])).collect()] == [0.0, 0.0]


# --- selection --------------------------------------------------------------------------------

def test_mutual_information_brute_force(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(0, 1)) for _ in range(500)]
    got = fs.mutual_info(spark.createDataFrame(rows, "c string, y int"), ["c"], "y").first().MI
    want, n = 0.0, len(rows)
    for c in ("a", "b", None):
        for y in (0, 1):
            nxy = sum(1 for r in rows if r == (c, y))
            nx, ny = sum(1 for r in rows if r[0] == c), sum(1 for r in rows if r[1] == y)
            want += nxy / n * math.log(nxy * n / (nx * ny))
    assert got == pytest.approx(want)


def test_anova_and_p_values(spark):
    rnd = random.Random(5)
    rows = [(rnd.gauss(0.5 * y, 1), rnd.gauss(0, 1), y) for y in (0, 1) for _ in range(200)]
    df = spark.createDataFrame(rows, "signal double, noise double, y int")
    stats = {r.COLUMN: r for r in fs.anova_f(df, ["signal", "noise"], "y").collect()}
    for i, c in enumerate(("signal", "noise")):
        a, b_ = (np.array([r[i] for r in rows if r[2] == y]) for y in (0, 1))
        mean = np.concatenate([a, b_]).mean()
        between = len(a) * (a.mean() - mean) ** 2 + len(b_) * (b_.mean() - mean) ** 2
        within = ((a - a.mean()) ** 2).sum() + ((b_ - b_.mean()) ** 2).sum()
        assert stats[c].F == pytest.approx(between / (within / 398))
    assert [s[0] for s in fs.fsel_anova(df, ["signal", "noise"], "y", 0.001)] == ["signal"]


def test_f_survival_known_values():
    # F(1, 10): upper 5 % at 4.9646; F(3, 20): upper 1 % at 4.9382; F(2, 2): P(F > f) = 1 / (1 + f)
    assert fs.f_survival(4.9646, 1, 10) == pytest.approx(0.05, abs=1e-5)
    assert fs.f_survival(4.9382, 3, 20) == pytest.approx(0.01, abs=1e-5)
    assert fs.f_survival(3.0, 2, 2) == pytest.approx(0.25)
    assert fs.f_survival(0.0, 2, 2) == 1.0 and fs.f_survival(None, 2, 2) == 1.0


def test_complete_linkage():
    d = np.array([[0, .1, .9, .8], [.1, 0, .75, .9], [.9, .75, 0, .2], [.8, .9, .2, 0]])
    labels = fs.complete_linkage(d, 0.7)
    assert labels[0] == labels[1] != labels[2] == labels[3]
    assert len(set(fs.complete_linkage(d, 0.05))) == 4


def test_cluster_kbest_keeps_best_of_each_cluster(spark):
    rnd = random.Random(6)
    rows = []
    for _ in range(400):
        y = rnd.randint(0, 1)
        a = rnd.gauss(y, 1)
        rows.append((a, a + rnd.gauss(0, .01), a + rnd.gauss(0, .05), rnd.gauss(y, 2), y))
    df = spark.createDataFrame(rows, "a double, a2 double, a3 double, b double, y int")
    out = fs.fsel_cluster_kbest(df, ["a", "a2", "a3", "b"], "y", k=2)
    by_cluster = {}
    for c, k, _, _ in out:
        by_cluster.setdefault(k, []).append(c)
    assert sorted(len(v) for v in by_cluster.values()) == [1, 2] and ["b"] in by_cluster.values()


# --- evaluation -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def scores(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(600):
        y = rnd.randint(0, 1)
        rows.append((y, round(min(max(rnd.gauss(0.4 + 0.2 * y, 0.2), 0.0), 1.0), 2)))
    return rows, spark.createDataFrame(rows, "Y int, SCORE double").withColumn("G", F.lit("g"))


def test_auc_brute_force(scores):
    rows, df = scores
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert ev.eval_auc(df, ["G"]).first().ROC_AUC == pytest.approx(want)


def test_threshold_invariants(scores):
    rows, df = scores
    out = ev.eval_threshold(df, ["G"]).orderBy(F.col("THRESHOLD").desc()).collect()
    n_pos = sum(y for y, _ in rows)
    assert len(out) == len({s for _, s in rows})
    for r in out:
        assert r.TP + r.FN == n_pos and r.TP + r.FP + r.TN + r.FN == len(rows)
        assert r.TP == sum(1 for y, s in rows if y and s >= r.THRESHOLD)
        assert r.FP == sum(1 for y, s in rows if not y and s >= r.THRESHOLD)
    assert all(a.TPR <= b.TPR and a.FPR <= b.FPR for a, b in zip(out, out[1:])) and (out[-1].TPR, out[-1].FPR) == (1, 1)


def test_roc_starts_at_origin_and_one_class_is_null(spark, scores):
    _, df = scores
    start = ev.eval_roc(df, ["G"]).orderBy(F.col("THRESHOLD").desc()).first()
    assert (start.THRESHOLD, start.TPR, start.FPR) == (math.inf, 0.0, 0.0)
    only = spark.createDataFrame([("g", 1, 0.5), ("g", 1, 0.7)], "G string, Y int, SCORE double")
    assert ev.eval_auc(only, ["G"]).first().ROC_AUC is None
    assert {r.FPR for r in ev.eval_threshold(only, ["G"]).collect()} == {None}


def test_metrics_brute_force(scores):
    rows, df = scores
    r = ev.eval_scores(df, ["G"]).first()
    y, s = np.array([a for a, _ in rows]), np.array([b for _, b in rows])
    hit = s >= 0.5
    c = np.clip(s, ev.EPS, 1 - ev.EPS)
    assert r.ACCURACY == pytest.approx(((hit == 1) == (y == 1)).mean())
    assert r.PRECISION == pytest.approx(y[hit].mean()) and r.RECALL == pytest.approx(hit[y == 1].mean())
    assert r.F1 == pytest.approx(2 * (hit & (y == 1)).sum() / (hit.sum() + y.sum()))
    assert r.LOG_LOSS == pytest.approx(-(y * np.log(c) + (1 - y) * np.log(1 - c)).mean())
    assert r.BRIER == pytest.approx(((s - y) ** 2).mean())


def test_macro_roc_is_the_interpolated_mean(spark, scores):
    rows, df = scores
    both = df.withColumn("CLS", F.lit(1)).unionByName(
        df.withColumn("Y", 1 - F.col("Y")).withColumn("SCORE", 1 - F.col("SCORE")).withColumn("CLS", F.lit(0)))
    got = [r.TPR for r in ev.eval_roc_macro(both, ["G"]).orderBy("FPR").collect()]
    curves = []
    for cls in (0, 1):
        pts = [(0.0, 0.0)]
        data = [(y if cls else 1 - y, s if cls else 1 - s) for y, s in rows]
        n_pos = sum(y for y, _ in data)
        for t in sorted({s for _, s in data}, reverse=True):
            pts.append((sum(1 for y, s in data if not y and s >= t) / (len(data) - n_pos),
                        sum(1 for y, s in data if y and s >= t) / n_pos))
        curve = []
        for k in range(101):
            g = k / 100
            top = [v for u, v in pts if abs(u - g) < 1e-12]
            curve.append(max(top) if top else float(np.interp(g, [u for u, _ in pts], [v for _, v in pts])))
        curves.append(curve)
    assert np.allclose(got, np.mean(curves, axis=0))
