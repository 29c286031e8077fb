"""Batch scoring of a feature snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import dt_lit
from snapmill.operators.calendar import model_pick
from snapmill.plans.training import TrainedModel
from snapmill.sources.store import SnapshotTable


def score_batch(features: DataFrame, trained: TrainedModel, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Keys, class probabilities and calibrated probabilities of the snapshot at d."""
    return trained.score(features.where(F.col(cfg.dt_key) == dt_lit(d)), cfg.pk)


def model_for(calendar: DataFrame, d: date, prod_id: str | None = None, cfg: EntityConfig = DEFAULT) -> str:
    """The model id for a date: from the calendar, else the production model, else an error."""
    wanted = calendar.sparkSession.createDataFrame([(d,)], f"{cfg.dt_key} date")
    row = model_pick(wanted, calendar, cfg.dt_key, prod_id or "").first()
    if not row.MODEL_ID:
        raise ValueError("no model in the calendar and none in production")
    return row.MODEL_ID


def run_scoring(features: DataFrame, calendar: DataFrame, models: dict[str, str], sink: SnapshotTable, d: date,
                prod_id: str | None = None, cfg: EntityConfig = DEFAULT) -> None:
    """Pick the model for d, score its snapshot and insert the result unless it is there already.

    models maps a model id to the folder it was saved in.
    """
    spark = features.sparkSession
    trained = TrainedModel.load(models[model_for(calendar, d, prod_id, cfg)], spark)
    sink.insert(score_batch(features, trained, d, cfg))
