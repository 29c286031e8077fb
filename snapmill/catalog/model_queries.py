"""Feature selection, model, evaluation, explanation and calendar queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from snapmill.catalog.inputs import once, xy_written
from snapmill.catalog.registry import query
from snapmill.catalog.sql import ctes, r, typed
from snapmill.operators import calendar as cal
from snapmill.operators import evaluate as ev
from snapmill.operators import explain as ex
from snapmill.operators import model as m
from snapmill.operators import select as fs
from snapmill.plans import training
from snapmill.sources.bindings import table

# --- selection --------------------------------------------------------------------------------

CATS = ["l_linestatus", "l_linenumber", "cat"]
NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def flagged_lines(spark, sf):
    """Line items with a binary label, a category with gaps and numeric columns with gaps."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_linestatus", "l_linenumber",
        F.when(F.col("l_partkey") % 7 != 0, (F.col("l_partkey") % 5).cast("string")).alias("cat"), *NUMS)


LINES = """WITH x AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_linestatus, l_linenumber,
  CASE WHEN l_partkey % 7 <> 0 THEN cast(l_partkey % 5 AS VARCHAR) END AS cat, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem)"""


def _mi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "COLUMN", greatest(sum(n / total * ln(n * total / (nx * ny))), 0) AS MI FROM (
    SELECT DISTINCT {c}, y, cast(count(*) OVER (PARTITION BY {c}, y) AS DOUBLE) AS n,
           cast(count(*) OVER (PARTITION BY {c}) AS DOUBLE) AS nx, cast(count(*) OVER (PARTITION BY y) AS DOUBLE) AS ny,
           cast(count(*) OVER () AS DOUBLE) AS total FROM x)"""


MI = LINES + ", mi AS (" + " UNION ALL ".join(_mi_sql(c) for c in CATS) + ") "


@query("fsel_mi_threshold", MI + f'SELECT "COLUMN", {r("MI", "MI", 9)} FROM mi WHERE MI > 0.00001', digits=9)
def fsel_mi_threshold(spark, sf):
    return fs.fsel_mi_threshold(fs.mutual_info(flagged_lines(spark, sf), CATS, "y"), 0.00001)


@query("fsel_mi_percentile", MI + f"""SELECT "COLUMN", {r('MI', 'MI', 9)}, "RANK" FROM (
SELECT *, row_number() OVER (ORDER BY MI DESC, "COLUMN") AS "RANK", count(*) OVER () AS k FROM mi)
WHERE "RANK" <= ceil(k * 75 / 100.0)""", digits=9)
def fsel_mi_percentile(spark, sf):
    return fs.fsel_mi_percentile(fs.mutual_info(flagged_lines(spark, sf), CATS, "y"))


def _f_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "COLUMN", (sum(n * pow(m - mm, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS F,
    count(*) - 1 AS DF_BETWEEN, cast(sum(n) - count(*) AS BIGINT) AS DF_WITHIN
    FROM (SELECT y, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM x GROUP BY y), (SELECT avg({c}) AS mm FROM x)"""


@query("fsel_anova", LINES + f'SELECT "COLUMN", {r("F", "F")}, DF_BETWEEN, DF_WITHIN FROM (' + " UNION ALL ".join(_f_sql(c) for c in NUMS) + ")")
def anova(spark, sf):
    """F statistics; the selection by p follows in fsel_anova_p."""
    return fs.anova_f(flagged_lines(spark, sf), NUMS, "y")


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@query("fsel_anova_p")
def fsel_anova_p(spark, sf):
    kinds = fs.feature_kinds(xy_written(spark, sf))
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    return _rows(spark, fs.fsel_anova(xy_written(spark, sf), numeric, "CONV_7D"), "COLUMN string, F double, P double")


@query("fsel_cluster_kbest")
def fsel_cluster_kbest(spark, sf):
    cols = ["AGE", "TENURE", "TOTAL_COMP", "TOTAL_FLOW_7D", "MAX_CR_UTIL_7D", "AVG_CR_UTIL_7D", "NUM_EVENT_7D",
            "DAYS_SINCE_LAST_EVENT", "MAX_NUM_ACCT_7D"]
    rows = fs.fsel_cluster_kbest(xy_written(spark, sf), cols, "CONV_7D")
    return _rows(spark, rows, "COLUMN string, CLUSTER int, F double, P double")


@query("fsel_filter")
def fsel_filter(spark, sf):
    kept = fs.fsel_filter(xy_written(spark, sf), "CONV_7D")
    return _rows(spark, [(i, c) for i, c in enumerate(kept)], "POSITION int, COLUMN string")


def _ready(spark, sf):
    """Selector inputs over all features, written once for the wrappers."""
    return once(spark, ("wrapper", sf), lambda: fs.wrapper_inputs(xy_written(spark, sf), "CONV_7D"))


@query("fsel_rfe")
def fsel_rfe(spark, sf):
    ready, cols = _ready(spark, sf)
    return fs.fsel_rfe(ready, cols, len(cols) // 2).rows(spark)


@query("fsel_rfecv")
def fsel_rfecv(spark, sf):
    return fs.fsel_rfecv(*_ready(spark, sf), 1, fs.MOMENTS).rows(spark)


@query("fsel_forward")
def fsel_forward(spark, sf):
    return fs.fsel_forward(*_ready(spark, sf), 6, fs.MOMENTS).rows(spark)


@query("fsel_backward")
def fsel_backward(spark, sf):
    ready, cols = _ready(spark, sf)
    return fs.fsel_backward(ready, cols, len(cols) - 6, fs.MOMENTS, scoring="average_precision").rows(spark)


@query("fsel_embedded")
def fsel_embedded(spark, sf):
    return fs.fsel_embedded(*_ready(spark, sf), "1.25*mean", "forest").rows(spark)


@query("fsel_preselected", "SELECT l_orderkey AS CUST_ID, l_quantity, l_tax FROM lineitem")
def fsel_preselected(spark, sf):
    df = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "CUST_ID")
    return fs.fsel_preselected(df, ["l_quantity", "l_tax"], tuning=True)


# --- model ------------------------------------------------------------------------------------

@query("label_encode", """
SELECT o_orderkey, cast(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS CLASS FROM orders""")
def label_encode(spark, sf):
    df = table(spark, sf, "orders")
    return m.label_encode(df, "o_orderpriority", m.fit_label_encoding(df, "o_orderpriority"), "CLASS").select("o_orderkey", "CLASS")


MODEL_COLS = ["GENDER", "SUPER_CITY", "AGE", "TOTAL_COMP", "NUM_EVENT_7D", "MAX_NUM_ACCT_7D"]
TREES = m.TreeParams()
LINEAR = m.LinearParams(loss="log")


def trained(spark, sf, kind: str = "linear", calibration: str = "sigmoid"):
    params = {"linear": LINEAR, "hinge": m.LinearParams(), "tree": TREES}[kind]
    return once(spark, ("model", sf, kind, calibration), lambda: training.train(
        xy_written(spark, sf), params, None, calibration=calibration))


def _scored(spark, sf, kind, calibration="sigmoid"):
    model = trained(spark, sf, kind, calibration)
    return model.score(xy_written(spark, sf), ["CUST_ID", "SNAP_DT", "CONV_7D"])


@query("model_gbt")
def model_gbt(spark, sf):
    return _scored(spark, sf, "tree")


@query("model_linear")
def model_linear(spark, sf):
    """The default linear classifier, with the hinge loss."""
    return _scored(spark, sf, "hinge")


@query("model_multiclass")
def model_multiclass(spark, sf):
    """Boosting of three classes: line items by their return flag."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("CUST_ID"), F.col("l_shipdate").cast("date").alias("SNAP_DT"), F.col("l_returnflag").alias("CONV_7D"),
        F.datediff(F.col("l_shipdate"), F.lit(date(1992, 1, 1))).alias("SHIP_DAY"), "l_linestatus",
        "l_linenumber",
        *NUMS)
    columns = ["SHIP_DAY", "l_linestatus", "l_linenumber", *NUMS]
    model = training.train(rows, m.TreeParams("multiclass", 10), None, columns)
    return model.score(rows.select("CUST_ID", "SNAP_DT", "CONV_7D", *columns), ["CUST_ID", "SNAP_DT", "CONV_7D"])


@query("tune_group_cv")
def tune_group_cv(spark, sf):
    """The trials of a random search with three grouped folds."""
    model = training.train(xy_written(spark, sf), LINEAR)
    rows = [(i, str(sorted(p.items())), float(s)) for i, p, s in model.trials]
    return spark.createDataFrame(rows, "TRIAL int, PARAMS string, ROC_AUC double")


@query("train_model")
def train_model(spark, sf):
    """Train, with tuning, on four fifths of the customers; AUC of the calibrated scores on both parts."""
    xy = xy_written(spark, sf)
    part = F.col("CUST_ID") % 5 != 0
    model = training.train(xy.where(part), LINEAR)
    long = training.evaluate(model, {"train": xy.where(part), "test": xy.where(~part)})
    return training.train_auc(long, 2)


@query("calib_sigmoid")
def calib_sigmoid(spark, sf):
    return _scored(spark, sf, "linear", "sigmoid")


@query("calib_isotonic")
def calib_isotonic(spark, sf):
    return _scored(spark, sf, "linear", "isotonic")


@query("coef_imp")
def coef_imp(spark, sf):
    model = trained(spark, sf)
    return m.coef_imp(model.model, model.features, spark)


@query("explain_tree")
def explain_tree(spark, sf):
    model = trained(spark, sf, "tree")
    data = model.prepared(xy_written(spark, sf), ["CUST_ID", "SNAP_DT", "CONV_7D"])
    return ex.explain_tree(model.model, data, model.features, "CONV_7D", ["CUST_ID", "SNAP_DT"])


@query("input_validate", ctes("xy") + f"SELECT {typed(['CUST_ID', *MODEL_COLS])} FROM xy")
def input_validate(spark, sf):
    xy = xy_written(spark, sf).select("CUST_ID", *MODEL_COLS)
    return ex.input_validate(xy.withColumn("AGE", F.col("AGE").cast("string")), xy.schema)


WEIGHTS = {"l_quantity": 0.4, "l_extendedprice": -0.00002, "l_discount": 3.0, "l_tax": -1.5}
LOCAL = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM lineitem)) * cast({w:.6f} AS DOUBLE) AS {c}" for c, w in WEIGHTS.items()) + " FROM lineitem"


@query("explain_linear", "SELECT l_orderkey, cast(l_linenumber AS BIGINT) AS l_linenumber, "
       + ", ".join(r(c, c) for c in WEIGHTS) + f" FROM ({LOCAL})")
def explain_linear(spark, sf):
    return ex.explain_linear(table(spark, sf, "lineitem"), WEIGHTS, ["l_orderkey", "l_linenumber"])


@query("explain_global", " UNION ALL ".join(
    f"SELECT '{c}' AS \"COLUMN\", {r(f'avg(abs({c}))', 'MEAN_ABS')} FROM ({LOCAL})" for c in WEIGHTS))
def explain_global(spark, sf):
    local = ex.explain_linear(table(spark, sf, "lineitem"), WEIGHTS, ["l_orderkey", "l_linenumber"])
    return ex.explain_global(local, list(WEIGHTS))


# --- evaluation -------------------------------------------------------------------------------

# two deterministic scores of every order: a fine one and one with many ties; m2 swaps their roles
FINE, TIED = "o_totalprice / (o_totalprice + 150000)", "(o_custkey % 101) / cast(101 AS DOUBLE)"
KINDS = [("m1", "PROB", FINE), ("m1", "CALIB", TIED), ("m2", "PROB", TIED), ("m2", "CALIB", FINE)]
LONG = "WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{mod}' AS MODEL, '{kind}' AS KIND, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS Y, {e} AS SCORE FROM orders"
    for mod, kind, e in KINDS) + """), long AS (
SELECT MODEL, KIND, 1 AS CLS, Y, SCORE FROM s UNION ALL SELECT MODEL, KIND, 0, 1 - Y, 1 - SCORE FROM s)"""


def order_scores(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("Y"),
        (F.col("o_totalprice") / (F.col("o_totalprice") + 150000)).alias("FINE"),
        ((F.col("o_custkey") % 101) / F.lit(101.0)).alias("TIED"))
    columns = [("m1", "PROB", "FINE"), ("m1", "CALIB", "TIED"), ("m2", "PROB", "TIED"), ("m2", "CALIB", "FINE")]
    rows = []
    for mod, kind, c in columns:
        for cls in (0, 1):
            score = F.col(c) if cls else 1 - F.col(c)
            y = F.col("Y") if cls else 1 - F.col("Y")
            rows.append(F.struct(F.lit(mod).alias("MODEL"), F.lit(kind).alias("KIND"), F.lit(cls).alias("CLS"),
                                 y.alias("Y"), score.alias("SCORE")))
    return orders.select(F.inline(F.array(*rows)))


def order_scores_of(spark, sf, mod="m1", kind="PROB"):
    return order_scores(spark, sf).where((F.col("MODEL") == mod) & (F.col("KIND") == kind)).select("CLS", "Y", "SCORE")


def _cum(groups: str, where: str) -> str:
    """Distinct scores per group with running and total counts."""
    return f""", c AS (SELECT {groups}, SCORE, cast(sum(Y) AS BIGINT) AS p, cast(sum(1 - Y) AS BIGINT) AS n FROM long {where} GROUP BY {groups}, SCORE),
t AS (SELECT *, cast(sum(p) OVER (PARTITION BY {groups} ORDER BY SCORE DESC) AS BIGINT) AS tp, cast(sum(n) OVER (PARTITION BY {groups} ORDER BY SCORE DESC) AS BIGINT) AS fp,
      cast(sum(p) OVER (PARTITION BY {groups}) AS BIGINT) AS P_ALL, cast(sum(n) OVER (PARTITION BY {groups}) AS BIGINT) AS N_ALL FROM c)"""


ONE = LONG + _cum("CLS", "WHERE MODEL = 'm1' AND KIND = 'PROB'")
TPR, FPR, PREC = "tp / cast(P_ALL AS DOUBLE)", "fp / cast(N_ALL AS DOUBLE)", "tp / cast(tp + fp AS DOUBLE)"


@query("eval_threshold", ONE + f"""
SELECT cast(CLS AS BIGINT) AS CLS, {r('SCORE', 'THRESHOLD', 9)}, tp AS TP, fp AS FP, N_ALL - fp AS TN, P_ALL - tp AS FN, {r(TPR, 'TPR', 9)}, {r(FPR, 'FPR', 9)},
       {r(PREC, 'PRECISION', 9)}, {r(TPR, 'RECALL', 9)} FROM t""", digits=9)
def eval_threshold(spark, sf):
    return ev.eval_threshold(order_scores_of(spark, sf), ["CLS"])


ROC = f"""
SELECT cast(CLS AS BIGINT) AS CLS, {r('SCORE', 'THRESHOLD', 9)}, {r(TPR, 'TPR', 9)}, {r(FPR, 'FPR', 9)} FROM t
UNION ALL SELECT DISTINCT cast(CLS AS BIGINT), cast('inf' AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM t"""


@query("eval_roc", ONE + ROC, digits=9)
def eval_roc(spark, sf):
    return ev.eval_roc(order_scores_of(spark, sf), ["CLS"])


@query("eval_pr", ONE + f"SELECT cast(CLS AS BIGINT) AS CLS, {r('SCORE', 'THRESHOLD', 9)}, {r(PREC, 'PRECISION', 9)}, {r(TPR, 'RECALL', 9)} FROM t", digits=9)
def eval_pr(spark, sf):
    return ev.eval_pr(order_scores_of(spark, sf), ["CLS"])


ALL_MODELS = LONG + _cum("MODEL, KIND", "WHERE CLS = 1")
AUC = "sum(p * ((N_ALL - fp) + n / cast(2 AS DOUBLE))) / max(cast(P_ALL AS DOUBLE) * N_ALL)"


@query("eval_auc", ALL_MODELS + f"SELECT MODEL, KIND, {r(AUC, 'ROC_AUC')} FROM t GROUP BY MODEL, KIND")
def eval_auc(spark, sf):
    return ev.eval_auc(order_scores(spark, sf).where("CLS = 1"), ["MODEL", "KIND"])


CUT = "sum({0}) FILTER (SCORE >= 0.5)"
TOTAL = "cast(max(P_ALL + N_ALL) AS DOUBLE)"
CLIP = "least(greatest(SCORE, 1e-15), 1 - 1e-15)"
METRIC_SQL = {
    "ROC_AUC": AUC,
    "PR_AUC": "sum(p * tp / cast(tp + fp AS DOUBLE)) / max(P_ALL)",
    "ACCURACY": f"(coalesce({CUT.format('p')}, 0) + coalesce(sum(n) FILTER (SCORE < 0.5), 0)) / {TOTAL}",
    "PRECISION": f"{CUT.format('p')} / nullif(cast({CUT.format('p + n')} AS DOUBLE), 0)",
    "RECALL": f"coalesce({CUT.format('p')}, 0) / cast(max(P_ALL) AS DOUBLE)",
    "F1": f"2.0 * coalesce({CUT.format('p')}, 0) / cast(coalesce({CUT.format('p + n')}, 0) + max(P_ALL) AS DOUBLE)",
    "LOG_LOSS": f"-sum(p * ln({CLIP}) + n * ln(1 - {CLIP})) / {TOTAL}",
    "BRIER": f"sum(p * (1 - SCORE) * (1 - SCORE) + n * SCORE * SCORE) / {TOTAL}",
}


@query("eval_scores", ALL_MODELS + ", v AS (SELECT MODEL, KIND, " + ", ".join(f"{e} AS {k}" for k, e in METRIC_SQL.items())
       + " FROM t GROUP BY MODEL, KIND)" + " UNION ALL ".join(
           f"SELECT '{k}' AS METRIC, MODEL, {r(f'''max({k}) FILTER (KIND = 'CALIB')''', 'CALIBRATED')}, {r(f'''max({k}) FILTER (KIND = 'PROB')''', 'RAW')} FROM v GROUP BY MODEL"
           for k in METRIC_SQL))
def eval_scores(spark, sf):
    return ev.score_table(ev.eval_scores(order_scores(spark, sf).where("CLS = 1"), ["MODEL", "KIND"]))


RAW_MODELS = LONG + _cum("MODEL", "WHERE KIND = 'PROB'")


def _raw(spark, sf):
    return order_scores(spark, sf).where("KIND = 'PROB'")


@query("eval_roc_agg_micro", RAW_MODELS + f"""
SELECT MODEL, {r('SCORE', 'THRESHOLD', 9)}, {r(TPR, 'TPR', 9)}, {r(FPR, 'FPR', 9)} FROM t
UNION ALL SELECT DISTINCT MODEL, cast('inf' AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM t""", digits=9)
def eval_roc_agg_micro(spark, sf):
    return ev.eval_roc_micro(_raw(spark, sf), ["MODEL"])


@query("eval_pr_agg_micro", RAW_MODELS + f"SELECT MODEL, {r('SCORE', 'THRESHOLD', 9)}, {r(PREC, 'PRECISION', 9)}, {r(TPR, 'RECALL', 9)} FROM t", digits=9)
def eval_pr_agg_micro(spark, sf):
    return ev.eval_pr_micro(_raw(spark, sf), ["MODEL"])


BY_CLASS = LONG + _cum("MODEL, CLS", "WHERE KIND = 'PROB'")


@query("eval_roc_agg_macro", BY_CLASS + f"""
, g AS (SELECT k FROM range(101) g(k)),
seg AS (SELECT t.*, tp - p AS tp0, fp - n AS fp0 FROM t WHERE n > 0),
pts AS (SELECT MODEL, CLS, k, (tp0 + p * ((k * N_ALL / cast(100 AS DOUBLE) - fp0) / n)) / P_ALL AS tpr
        FROM seg JOIN g ON k * N_ALL >= fp0 * 100 AND k * N_ALL < fp * 100
        UNION ALL SELECT DISTINCT MODEL, CLS, 100, cast(1 AS DOUBLE) FROM seg)
SELECT MODEL, {r('k / cast(100 AS DOUBLE)', 'FPR')}, {r('avg(tpr)', 'TPR')} FROM pts GROUP BY MODEL, k""")
def eval_roc_agg_macro(spark, sf):
    return ev.eval_roc_macro(_raw(spark, sf), ["MODEL"])


@query("eval_pr_agg_macro", BY_CLASS + f"""
, g AS (SELECT k FROM range(101) g(k)),
pts AS (SELECT MODEL, CLS, k, tp / cast(tp + fp AS DOUBLE) AS prec
        FROM t JOIN g ON k >= 1 AND k * P_ALL > (tp - p) * 100 AND k * P_ALL <= tp * 100
        UNION ALL SELECT DISTINCT MODEL, CLS, 0, cast(1 AS DOUBLE) FROM t)
SELECT MODEL, {r('k / cast(100 AS DOUBLE)', 'RECALL')}, {r('avg(prec)', 'PRECISION')} FROM pts GROUP BY MODEL, k""")
def eval_pr_agg_macro(spark, sf):
    return ev.eval_pr_macro(_raw(spark, sf), ["MODEL"])


# --- calendar ---------------------------------------------------------------------------------

# each ISO week with orders gets the model of its number; weeks divisible by 5 have none
def order_weeks(spark, sf):
    day = F.col("o_orderdate").cast("date")
    week = F.weekofyear(day)
    return (table(spark, sf, "orders")
            .select(F.extract(F.lit("YEAROFWEEK"), day).alias("ISO_YEAR"), week.alias("ISO_WEEK")).distinct()
            .where("ISO_WEEK % 5 <> 0")
            .select(F.concat(F.lit("v"), (F.col("ISO_WEEK") % 4).cast("string")).alias("MODEL_ID"), "ISO_YEAR", "ISO_WEEK"))


WEEKS = """WITH w AS (SELECT DISTINCT 'v' || (week(o_orderdate) % 4) AS MODEL_ID, date_trunc('week', o_orderdate) AS monday
  FROM orders WHERE week(o_orderdate) % 5 <> 0),
cal AS (SELECT MODEL_ID, cast(monday AS TIMESTAMP) AS START_TS, cast(monday + INTERVAL 7 DAY AS TIMESTAMP) AS END_TS FROM w)"""
PUT_START, PUT_END = datetime(1997, 3, 5, 12), datetime(1998, 6, 10, 6)
PUT = WEEKS + f""", put AS (
SELECT MODEL_ID, START_TS, least(END_TS, TIMESTAMP '{PUT_START}') AS END_TS FROM cal WHERE START_TS < least(END_TS, TIMESTAMP '{PUT_START}')
UNION ALL SELECT MODEL_ID, greatest(START_TS, TIMESTAMP '{PUT_END}'), END_TS FROM cal WHERE greatest(START_TS, TIMESTAMP '{PUT_END}') < END_TS
UNION ALL SELECT 'hot', TIMESTAMP '{PUT_START}', TIMESTAMP '{PUT_END}')"""


def weeks_calendar(spark, sf):
    return cal.calendar_weeks(order_weeks(spark, sf))


def put_calendar(spark, sf):
    return cal.calendar_put(weeks_calendar(spark, sf), "hot", PUT_START, PUT_END)


@query("calendar_weeks", WEEKS + "SELECT * FROM cal")
def calendar_weeks(spark, sf):
    return weeks_calendar(spark, sf)


@query("calendar_put", PUT + "SELECT * FROM put")
def calendar_put(spark, sf):
    return put_calendar(spark, sf)


@query("calendar_gapfill", PUT + """
SELECT * FROM put UNION ALL
SELECT 'prod', END_TS, nxt FROM (SELECT END_TS, lead(START_TS) OVER (ORDER BY START_TS) AS nxt FROM put) WHERE END_TS < nxt""")
def calendar_gapfill(spark, sf):
    return cal.calendar_gapfill(put_calendar(spark, sf), "prod")


@query("model_pick", PUT + """
SELECT o.o_orderkey, cast(o.o_orderdate AS DATE) AS SNAP_DT, coalesce(p.MODEL_ID, 'prod') AS MODEL_ID
FROM orders o LEFT JOIN put p ON cast(cast(o.o_orderdate AS DATE) AS TIMESTAMP) >= p.START_TS
  AND cast(cast(o.o_orderdate AS DATE) AS TIMESTAMP) < p.END_TS""")
def model_pick(spark, sf):
    dates = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("SNAP_DT"))
    return cal.model_pick(dates, put_calendar(spark, sf), "SNAP_DT", "prod")
