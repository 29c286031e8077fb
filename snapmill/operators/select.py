"""Feature selection: filters, wrappers and embedded methods.

Columns are scored jointly. Statistics come from one long-form aggregation; what reaches the
driver has one row per feature.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import hash32
from snapmill.operators import subset
from snapmill.operators.prep import BINARY_FILL, column_kind, fit_median, fit_woe, prep_impute_median, enc_woe
from snapmill.operators.profile import binarized
from snapmill.operators.ranked import long_form
from snapmill.runtime import collect_bounded, materialize, spread

# fixed values: default thresholds
MI_THRESHOLD = 0.005
MI_PERCENTILE = 75
P_THRESHOLD = 0.05
DENDRO_THRESHOLD = 0.7
TOP_K_CLUSTER = 2
CV_FOLDS = 3
# the learner whose candidate subsets are all scored from one set of moments, see subset
MOMENTS = "moments"


def fsel_preselected(df: DataFrame, selected: list[str], cfg: EntityConfig = DEFAULT, tuning: bool = False) -> DataFrame:
    """A saved column list; tuning also keeps the group column."""
    return df.select(*([cfg.entity_key] if tuning else []), *selected)


def mutual_info(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(COLUMN, MI) in nats between each discrete column and the label.

    A missing value is a category of its own; rows without a label do not count. The contingency
    counts of all columns come from one aggregation; marginals are sums of the counts.
    """
    df = df.where(F.col(label).isNotNull())
    # a null stays apart from a text that might be written the same
    rows = long_form(df, cols, "string", keep=[F.col(label).cast("string").alias("Y")]).select(
        "COLUMN", "Y", F.col("VALUE").isNull().alias("IS_NULL"), F.coalesce("VALUE", F.lit("")).alias("VALUE"))
    cell = rows.groupBy("COLUMN", "IS_NULL", "VALUE", "Y").agg(F.count(F.lit(1)).alias("N"))
    per_y = collect_bounded(df.groupBy(F.col(label).cast("string").alias("Y")).count(), 1000, "classes")
    total = sum(r["count"] for r in per_y)
    # classes are few, so the label's marginal is a literal; the category's is the row sum of its cells
    n_y = F.create_map(*[F.lit(x) for r in per_y for x in (r.Y, r["count"])]) if total else F.create_map()
    wide = cell.groupBy("COLUMN", "IS_NULL", "VALUE").agg(
        F.collect_list(F.struct("Y", "N")).alias("CELLS"), F.sum("N").alias("NX"))
    terms = wide.select("COLUMN", "NX", F.inline("CELLS")).select(
        "COLUMN", (F.col("N") / F.lit(float(total))
                   * F.log(F.col("N") * F.lit(float(total)) / (F.col("NX") * n_y[F.col("Y")]))).alias("T"))
    return terms.groupBy("COLUMN").agg(F.greatest(F.sum("T"), F.lit(0.0)).alias("MI"))


def fsel_mi_threshold(mi: DataFrame, threshold: float = MI_THRESHOLD) -> DataFrame:
    """Columns whose mutual information is above the threshold."""
    return mi.where(F.col("MI") > threshold)


def fsel_mi_percentile(mi: DataFrame, percentile: int = MI_PERCENTILE) -> DataFrame:
    """The best percentile of the columns, ties by name. mi has one row per column."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("MI").desc(), "COLUMN"))
    keep = F.ceil(F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) * F.lit(percentile) / 100)
    return mi.select("COLUMN", "MI", rank.alias("RANK"), keep.alias("KEEP")).where("RANK <= KEEP").drop("KEEP")


def anova_f(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(COLUMN, F, DF_BETWEEN, DF_WITHIN) of the one-way analysis of variance over the classes.

    Squares are taken around the group means, so large values do not cancel. F is infinite for a column
    that separates the classes without spread inside them, and null without spread at all, with one
    class, or with no more rows than classes.
    """
    groups = (long_form(df, cols, keep=[F.col(label).alias("Y")]).where(F.col("VALUE").isNotNull())
              .groupBy("COLUMN", "Y")
              .agg(F.count(F.lit(1)).alias("N"), F.avg("VALUE").alias("M"), F.var_pop("VALUE").alias("V")))
    overall = Window.partitionBy("COLUMN")
    mean = F.sum(F.col("N") * F.col("M")).over(overall) / F.sum("N").over(overall)
    parts = groups.select("COLUMN", "N", (F.col("N") * F.pow(F.col("M") - mean, F.lit(2.0))).alias("B"),
                          (F.col("N") * F.col("V")).alias("W"))
    sums = parts.groupBy("COLUMN").agg(F.sum("B").alias("B"), F.sum("W").alias("W"), F.sum("N").alias("N"),
                                       F.count(F.lit(1)).alias("K"))
    between, within = F.col("K") - 1, F.col("N") - F.col("K")
    f = F.try_divide(F.try_divide(F.col("B"), between), F.try_divide(F.col("W"), within))
    perfect = (F.col("W") == 0) & (F.col("B") > 0) & (within > 0)
    return sums.select("COLUMN", F.when(perfect, F.lit(float("inf"))).otherwise(f).alias("F"),
                       between.alias("DF_BETWEEN"), within.alias("DF_WITHIN"))


def f_survival(f: float | None, d1: float, d2: float) -> float:
    """P(F > f), by the continued fraction of the incomplete beta function."""
    if f is None or math.isnan(f) or f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    x, a, b = d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_cf(1 - x, b, a)
    return _beta_cf(x, a, b)


def _beta_cf(x: float, a: float, b: float) -> float:
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a \
        if 0 < x < 1 else 0.0
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return front * h


def fsel_anova(df: DataFrame, cols: list[str], label: str, p_threshold: float = P_THRESHOLD,
               exact: bool = True) -> list[tuple[str, float, float]]:
    """(column, F, p) of the numeric columns with p below the threshold, after median imputation."""
    filled = prep_impute_median(df, fit_median(df, cols, exact))
    rows = collect_bounded(anova_f(filled, cols, label), len(cols), "F statistics")
    scored = [(r.COLUMN, r.F, f_survival(r.F, r.DF_BETWEEN, r.DF_WITHIN)) for r in rows]
    return sorted((s for s in scored if s[2] < p_threshold), key=lambda s: s[0])


def complete_linkage(distance: np.ndarray, cut: float) -> list[int]:
    """Cluster number per feature: merge the closest pair until no pair is below the cut."""
    clusters = [[i] for i in range(len(distance))]
    while len(clusters) > 1:
        best = min(((max(distance[p][q] for p in a for q in b), i, j)
                    for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j))
        if best[0] >= cut:
            break
        _, i, j = best
        clusters[i] += clusters.pop(j)
    label = [0] * len(distance)
    for k, members in enumerate(clusters):
        for m in members:
            label[m] = k
    return label


def fsel_cluster_kbest(df: DataFrame, cols: list[str], label: str, k: int = TOP_K_CLUSTER,
                       cut: float = DENDRO_THRESHOLD, p_threshold: float = P_THRESHOLD,
                       exact: bool = True) -> list[tuple[str, int, float, float]]:
    """(column, cluster, F, p): the k best significant columns of each correlation cluster.

    The correlation matrix is computed by Spark; only it, columns x columns, is clustered here.
    """
    filled = prep_impute_median(df, fit_median(df, cols, exact))
    vectors = VectorAssembler(inputCols=cols, outputCol="V", handleInvalid="skip").transform(filled).select("V")
    corr = Correlation.corr(vectors, "V").head()[0].toArray()
    distance = 1.0 - np.abs(np.nan_to_num(corr))
    np.fill_diagonal(distance, 0.0)
    cluster = dict(zip(cols, complete_linkage(distance, cut), strict=True))
    rows = collect_bounded(anova_f(filled, cols, label), len(cols), "F statistics")
    scored = [(r.COLUMN, cluster[r.COLUMN], r.F or 0.0, f_survival(r.F, r.DF_BETWEEN, r.DF_WITHIN)) for r in rows]
    out = []
    for c in sorted(set(cluster.values())):
        mine = sorted((s for s in scored if s[1] == c), key=lambda s: (-s[2], s[0]))[:k]
        out += [s for s in mine if s[3] < p_threshold]
    return sorted(out)


@dataclass(frozen=True)
class FilterOptions:
    use_mi_threshold: bool = True
    mi_threshold: float = MI_THRESHOLD
    mi_percentile: int = MI_PERCENTILE
    use_cluster_kbest: bool = False
    p_threshold: float = P_THRESHOLD
    cut: float = DENDRO_THRESHOLD
    top_k: int = TOP_K_CLUSTER
    exact: bool = True


def feature_kinds(df: DataFrame, cfg: EntityConfig = DEFAULT) -> dict[str, str]:
    left_out = {*cfg.pk, cfg.target_key}
    kinds = {f.name: column_kind(f.dataType) for f in df.schema if f.name not in left_out}
    return {c: k for c, k in kinds.items() if k}


def fsel_filter(df: DataFrame, label: str, options: FilterOptions = FilterOptions(),
                cfg: EntityConfig = DEFAULT) -> list[str]:
    """Columns kept by the filter of their type: mutual information for binary and text columns,
    analysis of variance (or best per cluster) for numeric ones."""
    kinds = feature_kinds(df, cfg)
    kept: set[str] = set()
    prepared = df.withColumns({c: F.coalesce(binarized(c), F.lit(BINARY_FILL)) for c, k in kinds.items() if k == "binary"}) \
        if "binary" in kinds.values() else df
    for kind in ("binary", "text"):
        cols = [c for c, k in kinds.items() if k == kind]
        if cols:
            mi = mutual_info(prepared, cols, label)
            best = (fsel_mi_threshold(mi, options.mi_threshold) if options.use_mi_threshold
                    else fsel_mi_percentile(mi, options.mi_percentile))
            kept |= {r.COLUMN for r in collect_bounded(best.select("COLUMN"), len(cols), "features")}
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    if numeric and options.use_cluster_kbest:
        kept |= {r[0] for r in fsel_cluster_kbest(df, numeric, label, options.top_k, options.cut,
                                                  options.p_threshold, options.exact)}
    elif numeric:
        kept |= {r[0] for r in fsel_anova(df, numeric, label, options.p_threshold, options.exact)}
    return [c for c in df.columns if c in kept]


# --- wrappers and embedded selection ----------------------------------------------------------

@dataclass
class Selection:
    """Chosen columns, and the score or importance recorded on the way."""

    columns: list[str]
    trace: list[tuple[int, str, float]] = field(default_factory=list)

    def rows(self, spark) -> DataFrame:
        return spark.createDataFrame(self.trace, "STEP int, COLUMN string, SCORE double")


def learner(kind: str, label: str, seed: int = 0):
    if kind == "forest":
        return RandomForestClassifier(labelCol=label, featuresCol="V", numTrees=100, maxDepth=5, seed=seed)
    if kind == "linear":
        return LinearSVC(labelCol=label, featuresCol="V", standardization=True)
    if kind == "logistic":
        return LogisticRegression(labelCol=label, featuresCol="V")
    raise ValueError("base learner must be linear, logistic, forest or, for wrappers, moments")


def wrapper_inputs(df: DataFrame, label: str, cfg: EntityConfig = DEFAULT, sigma: float = 0.05, seed: int = 0,
                   exact: bool = True) -> tuple[DataFrame, list[str]]:
    """Numeric inputs for the selectors: flags as -1/0/1, categories as weight of evidence,
    numbers with the median for null; plus the fold number of the entity. Written once."""
    kinds = feature_kinds(df, cfg)
    out = df
    for c in [c for c, k in kinds.items() if k == "text"]:
        out = enc_woe(out, c, fit_woe(df, c, label), c, sigma, seed, cfg)
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    out = prep_impute_median(out, fit_median(df, numeric, exact)) if numeric else out
    cols = list(kinds)
    flags = {c: F.coalesce(binarized(c), F.lit(BINARY_FILL)).cast("double") for c, k in kinds.items() if k == "binary"}
    fold = (hash32(F.col(cfg.entity_key), seed) % CV_FOLDS).cast("int").alias("FOLD")
    ready = spread(out, *cfg.pk).select(fold, F.col(label).cast("double").alias("Y"),
                       *[flags.get(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in cols])
    return materialize(ready), cols


def _fit(ready: DataFrame, cols: list[str], kind: str, seed: int):
    data = VectorAssembler(inputCols=cols, outputCol="V").transform(ready).select("V", "Y")
    return learner(kind, "Y", seed).fit(data)


def importances(model, n: int) -> list[float]:
    if hasattr(model, "featureImportances"):
        return [float(x) for x in model.featureImportances.toArray()]
    return [abs(float(x)) for x in model.coefficients.toArray()[:n]]


def evaluator(scoring: str):
    """The evaluator of a score name; the label column is Y."""
    if scoring == "accuracy":
        return MulticlassClassificationEvaluator(labelCol="Y", metricName="accuracy")
    metric = {"roc_auc": "areaUnderROC", "average_precision": "areaUnderPR"}.get(scoring)
    if metric is None:
        raise ValueError("scoring must be roc_auc, average_precision or accuracy")
    return BinaryClassificationEvaluator(labelCol="Y", rawPredictionCol="rawPrediction", metricName=metric)


def cv_score(ready: DataFrame, cols: list[str], kind: str, seed: int = 0, folds: int = CV_FOLDS, scoring: str = "roc_auc") -> float:
    """Mean score over the folds. Folds are a stored column of the entity hash."""
    metric = evaluator(scoring)
    data = VectorAssembler(inputCols=cols, outputCol="V").transform(ready).select("V", "Y", "FOLD")
    scores = []
    for f in range(folds):
        model = learner(kind, "Y", seed).fit(data.where(F.col("FOLD") != f))
        scores.append(metric.evaluate(model.transform(data.where(F.col("FOLD") == f))))
    return sum(scores) / len(scores)


def _eliminate(ready: DataFrame, cols: list[str], n: int, kind: str, seed: int) -> Selection:
    left, trace = list(cols), []
    while len(left) > n:
        weights = importances(_fit(ready, left, kind, seed), len(left))
        worst = min(range(len(left)), key=lambda i: (weights[i], left[i]))
        trace.append((len(left), left[worst], weights[worst]))
        left.pop(worst)
    return Selection(left, trace)


def fsel_rfe(ready: DataFrame, cols: list[str], n_features: int, kind: str = "forest", seed: int = 0) -> Selection:
    """Drop the least important column until n_features are left."""
    if kind == MOMENTS:
        left, trace, _ = subset.eliminate(subset.fold_moments(ready, cols, CV_FOLDS).trainer(None), cols, n_features)
        return Selection(left, trace)
    return _eliminate(ready, cols, n_features, kind, seed)


def fsel_rfecv(ready: DataFrame, cols: list[str], min_features: int, kind: str = "forest", seed: int = 0,
               scoring: str = "roc_auc") -> Selection:
    """Eliminate down to min_features, cross-validate every size on the way, keep the best size."""
    if kind == MOMENTS:
        return Selection(*subset.eliminate_cv(ready, cols, min_features, CV_FOLDS, scoring))
    order = [c for _, c, _ in _eliminate(ready, cols, min_features, kind, seed).trace]
    best, trace = None, []
    for step in range(len(order) + 1):
        left = [c for c in cols if c not in order[:step]]
        score = cv_score(ready, left, kind, seed, scoring=scoring)
        trace.append((len(left), order[step] if step < len(order) else "", score))
        if best is None or score >= best[0]:
            best = (score, left)
    return Selection(best[1], trace)


def _sequential(ready: DataFrame, cols: list[str], n: int, kind: str, seed: int, forward: bool, scoring: str) -> Selection:
    if kind == MOMENTS:
        return Selection(*subset.sequential(ready, cols, n, CV_FOLDS, scoring, forward))
    chosen = [] if forward else list(cols)
    trace = []
    while len(chosen) < n if forward else len(chosen) > n:
        candidates = [c for c in cols if c not in chosen] if forward else list(chosen)
        tried = [(cv_score(ready, [*chosen, c] if forward else [x for x in chosen if x != c], kind, seed, scoring=scoring), c)
                 for c in candidates]
        score, pick = max(tried, key=lambda t: (t[0], t[1]))
        chosen = [*chosen, pick] if forward else [x for x in chosen if x != pick]
        trace.append((len(chosen), pick, score))
    return Selection(chosen, trace)


def fsel_forward(ready: DataFrame, cols: list[str], n_features: int, kind: str = "forest", seed: int = 0,
                 scoring: str = "roc_auc") -> Selection:
    """Add the column that raises the cross-validated score most, until n_features are chosen.

    kind "moments" scores all candidates of a step together; the others fit one model per candidate and fold.
    """
    return _sequential(ready, cols, n_features, kind, seed, forward=True, scoring=scoring)


def fsel_backward(ready: DataFrame, cols: list[str], n_features: int, kind: str = "forest", seed: int = 0,
                  scoring: str = "roc_auc") -> Selection:
    """Remove the column whose loss hurts the score least, until n_features are left."""
    return _sequential(ready, cols, n_features, kind, seed, forward=False, scoring=scoring)


def fsel_embedded(ready: DataFrame, cols: list[str], threshold: str | float | None = None, kind: str = "forest",
                  seed: int = 0) -> Selection:
    """Columns whose importance in one fitted model reaches the threshold: a number, 'mean',
    'median' or a multiple such as '1.25*mean' (the default is the mean)."""
    weights = importances(_fit(ready, cols, kind, seed), len(cols))
    cut = _threshold(threshold, weights)
    return Selection([c for c, w in zip(cols, weights, strict=True) if w >= cut],
                     [(i, c, w) for i, (c, w) in enumerate(zip(cols, weights, strict=True))])


def _threshold(rule: str | float | None, weights: list[float]) -> float:
    if isinstance(rule, (int, float)):
        return float(rule)
    factor, _, name = (rule or "mean").rpartition("*")
    base = {"mean": np.mean, "median": np.median}.get(name.strip())
    if base is None:
        raise ValueError("threshold must be a number, mean, median or a multiple of these")
    return float(factor or 1.0) * float(base(weights))
