"""Label rule and the joined training table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig


def label_rule(target: DataFrame) -> DataFrame:
    """Positives: more than one purchase, and more than 5 items or an amount above 50."""
    big = (F.col("TOTAL_PUR_NUM_F7D") > 5) | (F.col("TOTAL_PUR_AMT_F7D") > 50)
    return target.where((F.col("NUM_PUR_F7D") > 1) & big)


def joined_xy(features: DataFrame, target: DataFrame, dates: Iterable[date],
              cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Features of the given dates with a 0/1 label; no positive record means 0."""
    dates = list(dates)
    x = features.where(F.col(cfg.dt_key).isin(dates))
    y = (label_rule(target.where(F.col(cfg.dt_key).isin(dates)))
         .select(*cfg.pk, F.lit(True).alias("IS_POSITIVE")))
    return (x.join(y, cfg.pk, "left")
            .withColumn(cfg.target_key, F.when(F.col("IS_POSITIVE"), 1).otherwise(0))
            .drop("IS_POSITIVE"))


def label_counts(df: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    return df.groupBy(cfg.target_key).agg(F.count(F.lit(1)).alias("N_ROWS"))
