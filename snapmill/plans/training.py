"""Training sets, model training and the trained bundle."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.operators import sampling
from snapmill.operators.boosting import SoftmaxBoostingModel
from snapmill.operators.compiled import CompiledModel, compile_model
from snapmill.operators.evaluate import class_scores, eval_auc
from snapmill.operators.labels import joined_xy
from snapmill.operators.model import (
    LABEL, ROWS, VECTOR, Calibration, LabelEncoding, LinearParams, TreeParams, TuneParams, assembled, calib_isotonic,
    calib_sigmoid, class_probabilities, estimator_for, fit_label_encoding, foldable, folded, stratified_folds, tune_group_cv,
    with_params,
)
from snapmill.operators.prep import TablePrep, fit_by_dtype, prep_from_profile
from snapmill.operators.select import FilterOptions, fsel_filter
from snapmill.runtime import materialize, spread
from snapmill.sources.registry import TrainingRegistry

SAMPLE_METHODS = ("simple", "stratify")
SPLIT_METHODS = ("simple", "stratify", "group", "timeseries")


def make_training_set(features: DataFrame, target: DataFrame, dates: Iterable[date], sample_method: str = "stratify",
                      split_method: str = "group", sample_frac: float = 0.25, train_size: float = 0.8, seed: int = 0,
                      cfg: EntityConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(train, test): labelled features of the dates, down-sampled and split."""
    if sample_method not in SAMPLE_METHODS:
        raise ValueError(f"sample_method must be one of {SAMPLE_METHODS}")
    if split_method not in SPLIT_METHODS:
        raise ValueError(f"split_method must be one of {SPLIT_METHODS}")
    xy = joined_xy(features, target, dates, cfg)
    if sample_method == "stratify":
        sampled = sampling.sample_stratify(xy, sample_frac, cfg.target_key, seed, cfg)
    else:
        sampled = sampling.sample_simple(xy, sample_frac, seed, cfg)
    # the split draws its own hashes, so it is independent of the sample
    split_seed = seed + 1
    if split_method == "simple":
        marked = sampling.mark_simple(sampled, train_size, split_seed, cfg)
    elif split_method == "stratify":
        marked = sampling.mark_stratify(sampled, train_size, cfg.target_key, split_seed, cfg)
    elif split_method == "group":
        marked = sampling.mark_group(sampled, train_size, split_seed, cfg)
    else:
        marked = sampling.mark_timeseries(sampled, train_size, cfg)
    return sampling.split(marked)


def create_training_set(registry: TrainingRegistry, data_id: str, features: DataFrame, target: DataFrame,
                        dates: Iterable[date], **options) -> None:
    """Build a training set and register it under data_id, replacing an earlier one."""
    registry.put(data_id, *make_training_set(features, target, dates, **options))


@dataclass
class TrainedModel:
    """Everything a score needs: kept columns, preprocessing, classifier, calibration, classes."""

    columns: list[str]
    prep: TablePrep
    model: Model | SoftmaxBoostingModel | None
    calibration: Calibration
    encoding: LabelEncoding
    trials: list = field(default_factory=list)
    scorer: CompiledModel | None = None

    @property
    def compiled(self) -> CompiledModel:
        """The classifier as expressions, made once."""
        if self.scorer is None:
            self.scorer = compile_model(self.model, self.features)
        return self.scorer

    @property
    def features(self) -> list[str]:
        return self.prep.outputs()

    def prepared(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return self.prep.transform(df, keep)

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """keep..., PROB_CLS0.. and CALIB_CLS0.. per row. The keys stay on their row.

        A projection: the classifier is compiled to expressions, so no fitted model travels with the tasks.
        """
        n = len(self.encoding.classes)
        if self.compiled.n_classes != n:
            raise ValueError(f"the labels have {n} classes, the model {self.compiled.n_classes}")
        probs = self.compiled.score(self.prepared(df, keep), keep)
        calibrated = self.calibration.transform(probs, n)
        return calibrated.select(*keep, *[f"PROB_CLS{i}" for i in range(n)], *[f"CALIB_CLS{i}" for i in range(n)])

    def save(self, path: str, spark: SparkSession) -> None:
        """A folder with the parameters as text and the fitted models as pyspark.ml folders."""
        curves = [] if self.calibration.method == "isotonic" else self.calibration.curves
        doc = json.dumps({"columns": self.columns, "prep": self.prep.to_json(), "classes": self.encoding.classes,
                          "method": self.calibration.method, "curves": curves, "compiled": self.compiled.to_json(), "fitted": self.model is not None,
                          "boosted": self.model.to_json() if isinstance(self.model, SoftmaxBoostingModel) else None,
                          "n_curves": len(self.calibration.curves)})
        spark.createDataFrame([(doc,)], "DOC string").coalesce(1).write.mode("overwrite").text(f"{path}/doc")
        if self.model is not None and not isinstance(self.model, SoftmaxBoostingModel):
            self.model.write().overwrite().save(f"{path}/model")
        if self.calibration.method == "isotonic":
            for i, curve in enumerate(self.calibration.curves):
                curve.write().overwrite().save(f"{path}/isotonic{i}")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> TrainedModel:
        doc = json.loads(spark.read.text(f"{path}/doc").first()[0])
        if doc["boosted"]:
            model = SoftmaxBoostingModel.from_json(doc["boosted"])
        else:
            model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark) if doc["fitted"] else None
        curves = [tuple(c) for c in doc["curves"]] if doc["method"] != "isotonic" else [
            IsotonicRegressionModel.load(f"{path}/isotonic{i}") for i in range(doc["n_curves"])]
        return cls(doc["columns"], TablePrep.from_json(doc["prep"]), model, Calibration(doc["method"], curves),
                   LabelEncoding(doc["classes"]), scorer=CompiledModel.from_json(doc["compiled"]))


def train(train_df: DataFrame, params: TreeParams | LinearParams, tune: TuneParams | None = TuneParams(),
          columns: list[str] | None = None, profile: DataFrame | None = None, calibration: str = "sigmoid",
          filters: FilterOptions | None = FilterOptions(), exact: bool = True, seed: int = 0,
          cfg: EntityConfig = DEFAULT) -> TrainedModel:
    """Select, preprocess, tune, fit and calibrate.

    columns is a saved selection; without it the filters choose. profile gives the
    preprocessing; without it the chains are fitted by type. The prepared training rows are
    written once, in a fixed order inside partitions, so repeated fits read the same data. Where
    the fit allows it, equal prepared rows of a fold are written as one row with their number.
    """
    if calibration not in ("sigmoid", "sigmoid_raw", "isotonic"):
        raise ValueError("calibration must be sigmoid, sigmoid_raw or isotonic")
    encoding = fit_label_encoding(train_df, cfg.target_key)
    if columns is None:
        columns = (fsel_filter(train_df, cfg.target_key, filters, cfg) if filters is not None
                   else [c for c in train_df.columns if c not in (*cfg.pk, cfg.target_key)])
    if not columns:
        raise ValueError("no feature column was selected")
    chosen = train_df.select(*cfg.pk, cfg.target_key, *columns)
    prep = fit_by_dtype(chosen, cfg, exact) if profile is None else prep_from_profile(
        profile.where(F.col("COLUMN").isin(columns)))
    n = len(encoding.classes)
    tune_k = tune.n_cv if tune else 2
    labelled = chosen.withColumn("CLASS", encoding.encode(F.col(cfg.target_key)))
    folds = stratified_folds(labelled, cfg.entity_key, "CLASS", tune_k, seed)
    # rows are spread once, before they are joined and widened; both keep the partitions
    ready = prep.transform(spread(labelled, cfg.entity_key).join(folds, cfg.entity_key, "left").withColumn("FOLD", F.coalesce("FOLD", F.lit(0))),
                           [*cfg.pk, "CLASS", "FOLD"])
    balanced = params.class_weight == "balanced"
    outputs = prep.outputs()
    if foldable(params, tune is not None, n):
        rows = materialize(ready.sortWithinPartitions(*cfg.pk))
        distinct = spread(folded(rows, outputs, ["FOLD", "CLASS"]), "FOLD", "CLASS", *outputs).sortWithinPartitions("FOLD", "CLASS", *outputs)
        data = materialize(assembled(distinct, outputs, "CLASS", ["FOLD", ROWS], balanced, ROWS))
    else:
        data = materialize(assembled(ready, outputs, "CLASS", [*cfg.pk, "FOLD"], balanced).sortWithinPartitions(*cfg.pk))
    estimator = estimator_for(params, seed, n)
    trials: list = []
    if tune is not None:
        trials, best = tune_group_cv(data, estimator, tune, seed, n_classes=n)
        estimator = with_params(estimator, best)
    model = estimator.fit(data)
    scored = materialize(class_probabilities(model, data, n).drop(VECTOR))
    curve = (calib_isotonic(scored, n, LABEL) if calibration == "isotonic"
             else calib_sigmoid(scored, n, LABEL, logit=calibration == "sigmoid"))
    return TrainedModel(columns, prep, model, curve, encoding, trials)


def evaluate(trained: TrainedModel, parts: dict[str, DataFrame], cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Long score table (PART, KIND, CLS, Y, SCORE) of a model over named parts, written once."""
    n = len(trained.encoding.classes)
    out = None
    for name, df in parts.items():
        labelled = df.withColumn("CLASS", trained.encoding.encode(F.col(cfg.target_key)))
        scored = trained.score(labelled, [*cfg.pk, "CLASS"])
        for kind in ("PROB", "CALIB"):
            rows = class_scores(scored.withColumn("PART", F.lit(name)), n, ["PART"], "CLASS", f"{kind}_CLS", kind)
            out = rows if out is None else out.unionByName(rows)
    return materialize(out)


def train_auc(long: DataFrame, n_classes: int) -> DataFrame:
    """ROC-AUC per part of the calibrated scores: of class 1 when there are two, else one per class."""
    rows = long.where(F.col("KIND") == "CALIB")
    if n_classes == 2:
        rows = rows.where(F.col("CLS") == 1)
    return eval_auc(rows, ["PART", "CLS"])
