"""Scoring and comparison queries over models with fixed parameters, which the checking SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmill.catalog.inputs import D, features_at, xy_written
from snapmill.catalog.model_queries import METRIC_SQL, _cum
from snapmill.catalog.registry import query
from snapmill.catalog.sql import ctes, r
from snapmill.operators import model as m
from snapmill.operators.compiled import DUCKDB, CompiledModel
from snapmill.operators.prep import ColumnPrep, TablePrep
from snapmill.plans import compare, scoring, training
from snapmill.runtime import scratch_path
from snapmill.sources.bindings import table
from snapmill.sources.registry import TrainingRegistry
from snapmill.sources.store import SnapshotTable

COLUMNS = {"AGE": ColumnPrep("numeric", (20.0, 60.0), 40.0, (41.0, 11.5)), "TENURE": ColumnPrep("numeric", (0.5, 19.0), 9.0, (10.0, 5.25)),
           "TOTAL_COMP": ColumnPrep("numeric", (0.0, 20000.0), 5000.0, (9000.0, 6500.0)),
           "NUM_EVENT_7D": ColumnPrep("numeric", (0.0, 30.0), 0.0, (4.0, 3.0))}
NAMES = list(COLUMNS)
LINEAR = CompiledModel("linear", "logistic", NAMES, [[-0.35, 0.4, -0.25, 0.15, 0.8]])
TREES = CompiledModel("trees", "double_logistic", NAMES, [], [
    [3, 0.1, [0, -0.5, [-0.6], [-0.2]], [1, 0.75, [0.3], [0.7]]], [2, -0.4, [0.25], [0, 0.9, [-0.15], [0.4]]], [1, 0.0, [-0.1], [0.2]]],
    [1.0, 0.1, 0.1])
CLASSES = CompiledModel("linear", "softmax", NAMES, [[0.1, 0.5, 0.0, -0.25, 0.1], [-0.2, 0.0, 0.3, 0.2, 0.4], [0.0, -0.1, -0.2, 0.0, 0.6]])
FOREST = CompiledModel("trees", "share", NAMES, [], [
    [3, 0.0, [0.7, 0.2, 0.1], [0, 0.25, [0.1, 0.6, 0.3], [0.2, 0.2, 0.6]]], [1, 0.5, [0.5, 0.3, 0.2], [0.25, 0.25, 0.5]]], [1.0, 1.0])
CURVES = {"linear": [(0.9, 0.05), (1.2, -0.3)], "trees": [(1.0, 0.0), (0.8, 0.15)]}


def fixed(kind: str) -> training.TrainedModel:
    scorer = LINEAR if kind == "linear" else TREES
    return training.TrainedModel(NAMES, TablePrep(COLUMNS), None, m.Calibration("sigmoid", CURVES[kind]), m.LabelEncoding([0, 1]), scorer=scorer)


def _prepared() -> str:
    """The fitted chains over the columns of xy or features."""
    return ", ".join(
        f"(CASE WHEN {c} IS NULL THEN cast({p.fill} AS DOUBLE) ELSE least(greatest(cast({c} AS DOUBLE), {p.clip[0]}), {p.clip[1]}) END"
        f" - cast({p.center[0]} AS DOUBLE)) / cast({p.center[1]} AS DOUBLE) AS {c}" for c, p in COLUMNS.items())


def _two(kind: str) -> tuple[str, str]:
    """Raw and calibrated probability of class 1 as SQL."""
    scorer = LINEAR if kind == "linear" else TREES
    factor = 1 if kind == "linear" else 2
    p = f"1.0 / (1.0 + exp(-{factor} * ({scorer.margins(DUCKDB)[0]})))"
    a, b = CURVES[kind][1]
    q = f"least(greatest({p}, 1e-12), 1.0 - 1e-12)"
    return p, f"1.0 / (1.0 + exp(-({a} * ln({q} / (1.0 - {q})) + {b})))"


def _both(kind: str, source: str, keep: str) -> str:
    p, c = _two(kind)
    return f"SELECT {keep}, {p} AS P, {c} AS C FROM (SELECT {keep}, {_prepared()} FROM {source})"


SCORES = f"{r('1 - P', 'PROB_CLS0')}, {r('P', 'PROB_CLS1')}, {r('1 - C', 'CALIB_CLS0')}, {r('C', 'CALIB_CLS1')}"


@query("score_linear", ctes("xy") + f"SELECT CUST_ID, SNAP_DT, {SCORES} FROM ({_both('linear', 'xy', 'CUST_ID, SNAP_DT')})")
def score_linear(spark, sf):
    return fixed("linear").score(xy_written(spark, sf), ["CUST_ID", "SNAP_DT"])


@query("score_trees", ctes("xy") + f"SELECT CUST_ID, SNAP_DT, {SCORES} FROM ({_both('trees', 'xy', 'CUST_ID, SNAP_DT')})")
def score_trees(spark, sf):
    return fixed("trees").score(xy_written(spark, sf), ["CUST_ID", "SNAP_DT"])


def _many(scorer: CompiledModel, term: str) -> str:
    margins = ", ".join(f"{term.format(text)} AS e{i}" for i, text in enumerate(scorer.margins(DUCKDB)))
    total = " + ".join(f"e{i}" for i in range(scorer.n_classes))
    return ctes("xy") + "SELECT CUST_ID, " + ", ".join(r(f"e{i} / ({total})", f"PROB_CLS{i}") for i in range(scorer.n_classes)) + f"""
FROM (SELECT CUST_ID, {margins} FROM (SELECT CUST_ID, {_prepared()} FROM xy))"""


@query("score_softmax", _many(CLASSES, "exp({})"))
def score_softmax(spark, sf):
    return CLASSES.score(TablePrep(COLUMNS).transform(xy_written(spark, sf), ["CUST_ID"]), ["CUST_ID"])


@query("score_forest", _many(FOREST, "({})"))
def score_forest(spark, sf):
    return FOREST.score(TablePrep(COLUMNS).transform(xy_written(spark, sf), ["CUST_ID"]), ["CUST_ID"])


@query("score_batch", ctes("features") + f"SELECT CUST_ID, SNAP_DT, {SCORES} FROM ({_both('linear', 'features', 'CUST_ID, SNAP_DT')})")
def score_batch(spark, sf):
    """Save a model, pick it from a calendar, score the snapshot and insert it; read it back."""
    path = scratch_path(spark, "model")
    fixed("linear").save(path, spark)
    week = table(spark, sf, "events").agg(
        F.date_trunc("week", F.min("ts")).cast("timestamp_ntz").alias("START_TS"),
        F.max("ts").cast("timestamp_ntz").alias("END_TS")).select(F.lit("m1").alias("MODEL_ID"), "START_TS", "END_TS")
    sink = SnapshotTable(spark, scratch_path(spark, "scoring"))
    scoring.run_scoring(features_at(spark, sf), week, {"m1": path}, sink, D)
    return sink.read(D)


def _long(kind: str, name: str, source: str = "xy") -> str:
    """(MODEL, KIND, CLS, Y, SCORE) rows of a fixed model, with the customer for the parts."""
    return f"""SELECT '{name}' AS MODEL, CUST_ID, KIND, CLS, CASE WHEN CLS = 1 THEN y ELSE 1 - y END AS Y,
    CASE WHEN CLS = 1 THEN s ELSE 1 - s END AS SCORE
FROM (SELECT CUST_ID, cast(CONV_7D AS INTEGER) AS y, unnest(['PROB', 'CALIB']) AS KIND, unnest([P, C]) AS s
      FROM ({_both(kind, source, 'CUST_ID, CONV_7D')})), (SELECT unnest([0, 1]) AS CLS)"""


@query("eval_compute", ctes("xy") + f"""SELECT 'all' AS PART, KIND, cast(CLS AS BIGINT) AS CLS, cast(Y AS BIGINT) AS Y, {r('SCORE', 'SCORE')}
FROM ({_long('linear', 'm1')})""")
def eval_compute(spark, sf):
    """The long score table both curve and metric operators read."""
    return training.evaluate(fixed("linear"), {"all": xy_written(spark, sf)})


PART = "CASE WHEN CUST_ID % 5 <> 0 THEN 'train' ELSE 'test' END"


def registered(spark, sf) -> TrainingRegistry:
    """A registered pair: four fifths of the customers train."""
    registry = TrainingRegistry(spark, scratch_path(spark, "compare"))
    xy = xy_written(spark, sf)
    part = F.col("CUST_ID") % 5 != 0
    registry.put("pair", xy.where(part), xy.where(~part))
    return registry


@query("compare_models", ctes("xy", extra={"long": f"SELECT *, {PART} AS PART FROM ({_long('linear', 'linear')} UNION ALL {_long('trees', 'trees')})"})
       + _cum("MODEL, PART, KIND", "WHERE CLS = 1") + ", v AS (SELECT MODEL, PART, KIND, " + ", ".join(f"{e} AS {k}" for k, e in METRIC_SQL.items())
       + " FROM t GROUP BY MODEL, PART, KIND)" + " UNION ALL ".join(
           f"SELECT '{k}' AS METRIC, MODEL, PART, cast(1 AS BIGINT) AS CLS, {r(f'''max({k}) FILTER (KIND = 'CALIB')''', 'CALIBRATED')}, "
           f"{r(f'''max({k}) FILTER (KIND = 'PROB')''', 'RAW')} FROM v GROUP BY MODEL, PART" for k in METRIC_SQL))
def compare_models(spark, sf):
    """Metrics of two models on both sides of a registered pair."""
    long = compare.compared(registered(spark, sf), "pair", {"linear": fixed("linear"), "trees": fixed("trees")})
    return compare.compared_scores(long)


@query("compare_fitted")
def compare_fitted(spark, sf):
    """The same for two models that are fitted on the registered train side: default hinge and boosting."""
    registry = registered(spark, sf)
    train, _ = registry.fetch("pair")
    models = {"hinge": training.train(train, m.LinearParams(), None), "boosting": training.train(train, m.TreeParams(n_estimators=20), None)}
    return compare.compared_scores(compare.compared(registry, "pair", models))


FOLD_SQL = ctes("xy") + """, n AS (SELECT count(*) FILTER (CONV_7D = 0) <= count(*) FILTER (CONV_7D = 1) AS rare0 FROM xy),
h AS (SELECT CUST_ID, count(*) FILTER (CONV_7D = CASE WHEN rare0 THEN 0 ELSE 1 END) AS a, count(*) FILTER (CONV_7D = CASE WHEN rare0 THEN 1 ELSE 0 END) AS b
      FROM xy, n GROUP BY CUST_ID),
k AS (SELECT CUST_ID, (row_number() OVER (ORDER BY -a, CASE WHEN a % 2 = 0 THEN -b ELSE b END,
        cast('0x' || substr(md5(CUST_ID || '|0'), 1, 8) AS BIGINT), CUST_ID) - 1) % 6 AS place FROM h)
SELECT CUST_ID, CASE WHEN place < 3 THEN place ELSE 5 - place END AS FOLD FROM k"""


@query("tune_folds", FOLD_SQL)
def tune_folds(spark, sf):
    """The stratified folds that tuning uses."""
    return m.stratified_folds(xy_written(spark, sf), "CUST_ID", "CONV_7D", 3)
