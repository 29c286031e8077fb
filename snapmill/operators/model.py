"""Classifiers, tuning and calibration on pyspark.ml."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill.functions.exprs import hash32, logistic
from snapmill.operators.boosting import SoftmaxBoosting, SoftmaxBoostingModel
from snapmill.operators.evaluate import class_scores, eval_scores
from snapmill.operators.ranked import running_sums
from snapmill.runtime import collect_bounded, materialize

VECTOR, RAW, PROB, PRED = "V", "rawPrediction", "probability", "prediction"
WEIGHT, LABEL = "W", "Y"
# of folded data: how many rows a row stands for
ROWS = "N_ROWS"


@dataclass(frozen=True)
class TreeParams:
    objective: str = "binary"           # or multiclass
    n_estimators: int = 100
    boosting_type: str = "gbdt"         # or rf
    class_weight: str | None = None     # or balanced


@dataclass(frozen=True)
class LinearParams:
    loss: str = "hinge"                 # or log
    fit_intercept: bool = True
    max_iter: int = 1000
    class_weight: str | None = None     # or balanced


@dataclass(frozen=True)
class TuneParams:
    n_cv: int = 3
    n_trials: int = 30
    scoring: str = "roc_auc"


@dataclass(frozen=True)
class LabelEncoding:
    """Target values in ascending order; a value's position is its class number."""

    classes: list = field(default_factory=list)

    def encode(self, c: Column) -> Column:
        code = F.lit(None).cast("int")
        for i, v in enumerate(self.classes):
            code = F.when(c == F.lit(v), i).otherwise(code)
        return code


def fit_label_encoding(df: DataFrame, label: str, max_classes: int = 1000) -> LabelEncoding:
    rows = collect_bounded(df.select(label).where(F.col(label).isNotNull()).distinct(), max_classes, "classes")
    return LabelEncoding(sorted(r[0] for r in rows))


def label_encode(df: DataFrame, label: str, encoding: LabelEncoding, out: str) -> DataFrame:
    return df.withColumn(out, encoding.encode(F.col(label)))


def assembled(df: DataFrame, features: list[str], label: str, keep: list[str] | None = None,
              balanced: bool = False, rows: str | None = None) -> DataFrame:
    """Vector, label and weight columns. Balanced weights give every class the same total; a row of folded data
    weighs as much as the rows it stands for."""
    weight = F.lit(1.0)
    if balanced:
        count = F.sum(F.col(rows) if rows else F.lit(1)).alias("count")
        counts = {r[label]: r["count"] for r in collect_bounded(df.groupBy(label).agg(count), 1000, "classes")}
        total = sum(counts.values())
        for v, n in counts.items():
            weight = F.when(F.col(label) == v, total / (len(counts) * n)).otherwise(weight)
    if rows:
        weight = weight * F.col(rows)
    out = VectorAssembler(inputCols=features, outputCol=VECTOR).transform(df)
    return out.select(*(keep or []), VECTOR, F.col(label).cast("double").alias(LABEL), weight.alias(WEIGHT))


def folded(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """One row per distinct (keep, cols), with ROWS, the number of rows it stands for.

    A loss that is a sum over rows does not change, only the order of its terms; every pass of a fit then reads the
    distinct rows. Map-side partials count a row that very many share. Where no row repeats, this is one shuffle more.
    """
    return df.groupBy(*keep, *cols).agg(F.count(F.lit(1)).cast("double").alias(ROWS))


def foldable(params: TreeParams | LinearParams, tuned: bool, n_classes: int) -> bool:
    """Whether a fit gives the same model for equal rows as for one row of their weight.

    Forests and tuned boosting draw rows, and count them per leaf. More than two classes are scored by their rows.
    """
    return n_classes == 2 and (isinstance(params, LinearParams) or (params.boosting_type == "gbdt" and not tuned))


def tree_estimator(params: TreeParams, seed: int = 0, n_classes: int = 2):
    if params.boosting_type not in ("gbdt", "rf"):
        raise ValueError("boosting_type must be gbdt or rf; dart and goss are not offered")
    if params.boosting_type == "gbdt" and (params.objective == "multiclass" or n_classes > 2):
        return SoftmaxBoosting(n_classes, maxIter=params.n_estimators, seed=seed, features=VECTOR, label=LABEL, weight=WEIGHT)
    if params.boosting_type == "rf":
        return RandomForestClassifier(featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, seed=seed,
                                      numTrees=params.n_estimators, maxDepth=5)
    return GBTClassifier(featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, seed=seed,
                         maxIter=params.n_estimators, maxDepth=5)


def linear_estimator(params: LinearParams):
    if params.loss == "log":
        return LogisticRegression(featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, maxIter=params.max_iter,
                                  fitIntercept=params.fit_intercept)
    if params.loss == "hinge":
        return LinearSVC(featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, maxIter=params.max_iter,
                         fitIntercept=params.fit_intercept)
    raise ValueError("loss must be log or hinge; the other losses have no distributed solver here")


def estimator_for(params: TreeParams | LinearParams, seed: int = 0, n_classes: int = 2):
    return tree_estimator(params, seed, n_classes) if isinstance(params, TreeParams) else linear_estimator(params)


def search_space(estimator) -> dict[str, tuple]:
    """fixed values: ranges of the searched parameters, as (kind, low, high) of each estimator."""
    if isinstance(estimator, GBTClassifier):
        return {"stepSize": ("log", 0.001, 0.35), "maxDepth": ("int", 3, 12), "subsamplingRate": ("lin", 0.3, 1.0),
                "minInfoGain": ("log", 1e-3, 1e2), "minInstancesPerNode": ("int", 1, 20), "featureSubsetStrategy": ("share", 0.3, 1.0)}
    if isinstance(estimator, SoftmaxBoosting):
        return {"stepSize": ("log", 0.001, 0.35), "maxDepth": ("int", 3, 12), "subsamplingRate": ("lin", 0.3, 1.0),
                "minInfoGain": ("log", 1e-3, 1e2), "minInstancesPerNode": ("int", 1, 20), "regParam": ("log", 1e-6, 1e2)}
    if isinstance(estimator, RandomForestClassifier):
        return {"maxDepth": ("int", 3, 12), "subsamplingRate": ("lin", 0.3, 1.0),
                "minInfoGain": ("log", 1e-3, 1e2), "minInstancesPerNode": ("int", 1, 20)}
    if isinstance(estimator, LogisticRegression):
        return {"regParam": ("log", 1e-7, 1e7), "elasticNetParam": ("lin", 0.0, 1.0)}
    return {"regParam": ("log", 1e-7, 1e7)}


def random_trials(estimator, n: int, seed: int = 0) -> list[dict]:
    """n parameter sets drawn from the search space; the first keeps the defaults."""
    rng = random.Random(seed)
    trials = [{}]
    for _ in range(n - 1):
        draw = {}
        for name, (kind, lo, hi) in search_space(estimator).items():
            if kind == "int":
                value = rng.randint(lo, hi)
            elif kind == "log":
                value = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            elif kind == "share":
                value = str(round(rng.uniform(lo, hi), 4))
            else:
                value = rng.uniform(lo, hi)
            draw[estimator.getParam(name)] = value
        trials.append(draw)
    return trials[:n]


def stratified_folds(df: DataFrame, entity: str, label: str, k: int, seed: int = 0) -> DataFrame:
    """(entity, FOLD): every entity in one fold, with the classes' rows spread evenly over the folds.

    Entities are put in one order by how many rows of each class they have: of the rarest class descending,
    of the next class descending or ascending by turns, and so on; equals by hash. They are then dealt to
    the folds to and fro (0 1 2 2 1 0 0 ...). Entities with the same counts are so shared out to within one,
    and along the order neighbouring counts make up for each other. The order is a range partition with
    running counts, so a common histogram is not one task's work. Rows without a label do not count, rows
    without an entity get no fold.
    """
    labelled = df.where(F.col(label).isNotNull() & F.col(entity).isNotNull())
    totals = collect_bounded(labelled.groupBy(label).count(), 1000, "classes")
    classes = [r[label] for r in sorted(totals, key=lambda r: (r["count"], str(r[label])))]
    counts = labelled.groupBy(entity).agg(*[F.count_if(F.col(label) == F.lit(c)).alias(f"_N{i}") for i, c in enumerate(classes)])
    order, before = [], F.lit(0)
    for i in range(len(classes)):
        n = F.col(f"_N{i}")
        order.append(-n if i == 0 else F.when(before % 2 == 0, -n).otherwise(n))
        before = before + n
    keyed = counts.select(entity, F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], hash32(F.col(entity), seed).alias("h"),
                                           F.col(entity).alias("e")).alias("_ORDER"), F.lit(1).alias("_ONE"))
    at = F.pmod(F.col("CUM__ONE") - 1, F.lit(2 * k))
    return running_sums(keyed, [], "_ORDER", ["_ONE"]).select(
        entity, F.when(at < k, at).otherwise(2 * k - 1 - at).cast("int").alias("FOLD"))


def tune_group_cv(data: DataFrame, estimator, tune: TuneParams = TuneParams(), seed: int = 0,
                  fold: str = "FOLD", parallelism: int = 8, n_classes: int = 2) -> tuple[list[tuple[int, dict, float]], dict]:
    """(trials, best parameters) of a random search scored by cross-validation over a stored fold column.

    The folds of stratified_folds keep an entity together and the classes balanced. With more than two
    classes the score is the mean over the classes, each against the others.
    """
    metric = {"roc_auc": "areaUnderROC", "average_precision": "areaUnderPR"}.get(tune.scoring)
    if metric is None:
        raise ValueError("scoring must be roc_auc or average_precision")
    maps = random_trials(estimator, tune.n_trials, seed)
    if n_classes > 2:
        scores = [_multiclass_score(data, with_params(estimator, {_name(p): v for p, v in m.items()}), tune, fold, n_classes) for m in maps]
        trials = [(i, {_name(p): v for p, v in m.items()}, s) for i, (m, s) in enumerate(zip(maps, scores, strict=True))]
        return trials, max(trials, key=lambda t: (t[2], -t[0]))[1]
    measure = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=RAW, metricName=metric)
    if ROWS in data.columns:
        measure = measure.setWeightCol(ROWS)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, numFolds=tune.n_cv, foldCol=fold, evaluator=measure,
                        parallelism=parallelism, seed=seed)
    scores = cv.fit(data).avgMetrics
    trials = [(i, {p.name: v for p, v in m.items()}, s) for i, (m, s) in enumerate(zip(maps, scores, strict=True))]
    best = max(trials, key=lambda t: (t[2], -t[0]))
    return trials, best[1]


def _name(param) -> str:
    return param if isinstance(param, str) else param.name


def _multiclass_score(data: DataFrame, estimator, tune: TuneParams, fold: str, n_classes: int) -> float:
    """Mean over folds and classes of a class's score against the others."""
    found = []
    for f in range(tune.n_cv):
        model = estimator.fit(data.where(F.col(fold) != f))
        scored = class_probabilities(model, data.where(F.col(fold) == f).select(LABEL, VECTOR), n_classes)
        stats = eval_scores(class_scores(scored, n_classes, [], LABEL, "PROB_CLS"), ["CLS"])
        column = "ROC_AUC" if tune.scoring == "roc_auc" else "PR_AUC"
        found += [r[0] for r in collect_bounded(stats.select(column), n_classes, "class scores") if r[0] is not None]
    return sum(found) / len(found) if found else float("-inf")


def with_params(estimator, params: dict):
    return estimator.copy({estimator.getParam(k): v for k, v in params.items()})


def class_probabilities(model: Model, df: DataFrame, n_classes: int, prefix: str = "PROB_CLS") -> DataFrame:
    """df with one probability column per class. A margin model is squashed by the logistic."""
    if isinstance(model, SoftmaxBoostingModel):
        if model.numClasses != n_classes:
            raise ValueError(f"the labels have {n_classes} classes, the model {model.numClasses}")
        return model.probabilities(df, prefix)
    out = model.transform(df)
    if PROB in out.columns:
        p = vector_to_array(PROB)
        if model.numClasses != n_classes:
            raise ValueError(f"the labels have {n_classes} classes, the model {model.numClasses}")
        probs = [F.get(p, F.lit(i)).alias(f"{prefix}{i}") for i in range(n_classes)]
    else:
        p1 = logistic(F.get(vector_to_array(RAW), F.lit(1)))
        probs = [(1.0 - p1).alias(f"{prefix}0"), p1.alias(f"{prefix}1")]
    return out.select(*df.columns, *probs)


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1.0 - 1e-12))
    return F.log(q / (1.0 - q))


@dataclass
class Calibration:
    """One curve per class: sigmoid (a, b) on the logit (sigmoid_raw: on the score), or isotonic knots."""

    method: str
    curves: list

    def apply(self, p: Column, i: int) -> Column:
        curve = self.curves[i]
        if self.method in ("sigmoid", "sigmoid_raw"):
            a, b = curve
            return logistic(F.lit(a) * (_logit(p) if self.method == "sigmoid" else p) + F.lit(b))
        return F.get(vector_to_array(F.col(f"_ISO{i}")), F.lit(0))

    def transform(self, df: DataFrame, n_classes: int, prefix: str = "PROB_CLS", out: str = "CALIB_CLS") -> DataFrame:
        if self.method == "isotonic":
            work = df
            for i, model in enumerate(self.curves):
                model = model.setFeaturesCol(f"{prefix}{i}").setPredictionCol(f"_ISO{i}")
                work = model.transform(work)
            raw = [F.col(f"_ISO{i}") for i in range(len(self.curves))]
        else:
            work, raw = df, [self.apply(F.col(f"{prefix}{i}"), i) for i in range(len(self.curves))]
        if n_classes == 2:
            one = raw[-1]
            values = [1.0 - one, one]
        else:
            total = sum(raw[1:], raw[0])
            values = [F.coalesce(F.try_divide(r, total), F.lit(1.0 / n_classes)) for r in raw]
        return work.select(*df.columns, *[v.alias(f"{out}{i}") for i, v in enumerate(values)])


def _score_groups(scored: DataFrame, column: str, is_class: Column) -> DataFrame:
    """Mean outcome and weight per distinct score: the calibrators see no more rows than that."""
    rows = F.col(ROWS) if ROWS in scored.columns else F.lit(1.0)
    hits = F.sum(F.when(is_class, rows).when(is_class.isNotNull(), 0.0))
    known = F.sum(F.when(is_class.isNotNull(), rows))
    return (scored.groupBy(F.col(column).alias("S")).agg(F.try_divide(hits, known).alias("RATE"), F.sum(rows).alias("N")))


def calib_sigmoid(scored: DataFrame, n_classes: int, label: str = LABEL, prefix: str = "PROB_CLS",
                  logit: bool = True) -> Calibration:
    """Platt scaling per class of a fitted model's scores, on their logit or on the scores themselves.

    The solver reads its rows more than once before it keeps them, so the scores are grouped into a table first.
    """
    curves = []
    for i in range(n_classes):
        g = materialize(_score_groups(scored, f"{prefix}{i}", F.col(label) == i))
        rows = g.select(array_to_vector(F.array(_logit(F.col("S")) if logit else F.col("S").cast("double"))).alias("X"), F.inline(F.array(
            F.struct(F.lit(1.0).alias("Y"), (F.col("N") * F.col("RATE")).alias("W")),
            F.struct(F.lit(0.0).alias("Y"), (F.col("N") * (1.0 - F.col("RATE"))).alias("W"))))).where("W > 0")
        m = LogisticRegression(featuresCol="X", labelCol="Y", weightCol="W").fit(rows)
        curves.append((float(m.coefficients[0]), float(m.intercept)))
    return Calibration("sigmoid" if logit else "sigmoid_raw", curves)


def calib_isotonic(scored: DataFrame, n_classes: int, label: str = LABEL, prefix: str = "PROB_CLS") -> Calibration:
    """Isotonic regression per class, exact at every number of scores.

    The solver sees one weighted point per distinct score. It range-partitions them and pools adjacent
    violators inside each part; blocks pool further exactly, so only the parts' blocks meet in the end.
    """
    curves = []
    for i in range(n_classes):
        g = _score_groups(scored, f"{prefix}{i}", F.col(label) == i)
        points = g.select(F.col("S").alias("X"), F.col("RATE").alias("Y"), F.col("N").alias("W"))
        curves.append(IsotonicRegression(featuresCol="X", labelCol="Y", weightCol="W").fit(points))
    return Calibration("isotonic", curves)


def coef_imp(model: Model, features: list[str], spark) -> DataFrame:
    """(COLUMN, VALUE): coefficients with INTERCEPT_ first, or feature importances."""
    if hasattr(model, "coefficients"):
        rows = [("INTERCEPT_", float(model.intercept))]
        rows += [(c, float(v)) for c, v in zip(features, model.coefficients.toArray(), strict=True)]
    elif hasattr(model, "featureImportances"):
        rows = [(c, float(v)) for c, v in zip(features, model.featureImportances.toArray(), strict=True)]
    else:
        raise TypeError("the model has neither coefficients nor importances")
    return spark.createDataFrame([(i, c, v) for i, (c, v) in enumerate(rows)], "POSITION int, COLUMN string, VALUE double")
