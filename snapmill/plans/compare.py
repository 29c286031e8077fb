"""Several trained models on one registered data set."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.operators import evaluate as ev
from snapmill.plans.training import TrainedModel
from snapmill.runtime import materialize
from snapmill.sources.registry import TrainingRegistry

PARTS = ("train", "test")


def compared(registry: TrainingRegistry, data_id: str, models: Mapping[str, TrainedModel], parts: tuple[str, ...] = PARTS,
             cfg: EntityConfig = DEFAULT) -> DataFrame:
    """(MODEL, PART, KIND, CLS, Y, SCORE): raw and calibrated scores of every model on the registered sides.

    Written once, since all metrics and curves read it. A row is scored by all models from one scan of its
    side's columns each; rows whose target a model does not know are left out for that model.
    """
    sides = dict(zip(PARTS, registry.fetch(data_id), strict=True))
    out = None
    for part in parts:
        for name, model in models.items():
            n = len(model.encoding.classes)
            labelled = sides[part].withColumn("CLASS", model.encoding.encode(F.col(cfg.target_key))).where("CLASS is not null")
            scored = model.score(labelled, ["CLASS"]).withColumns({"MODEL": F.lit(name), "PART": F.lit(part)})
            for kind in ("PROB", "CALIB"):
                rows = ev.class_scores(scored, n, ["MODEL", "PART"], "CLASS", f"{kind}_CLS", kind)
                out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no model or no part to compare")
    return materialize(out.select("MODEL", "PART", "KIND", "CLS", "Y", "SCORE"))


def compared_scores(long: DataFrame, two_classes: bool = True) -> DataFrame:
    """(METRIC, MODEL, PART, CLS, CALIBRATED, RAW); of two classes only class 1 is reported."""
    rows = long.where("CLS = 1") if two_classes else long
    stats = ev.eval_scores(rows, ["MODEL", "PART", "CLS", "KIND"])
    values = stats.select("MODEL", "PART", "CLS", "KIND", F.inline(F.array(*[
        F.struct(F.lit(m).alias("METRIC"), F.col(m).alias("VALUE")) for m in ev.METRICS])))
    return values.groupBy("METRIC", "MODEL", "PART", "CLS").agg(
        F.max(F.when(F.col("KIND") == "CALIB", F.col("VALUE"))).alias("CALIBRATED"),
        F.max(F.when(F.col("KIND") == "PROB", F.col("VALUE"))).alias("RAW"))
