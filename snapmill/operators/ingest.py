"""Projection of landed files into RAW tables and of RAW tables into EXTRACT tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import dt_lit
from snapmill.operators.features import batches_covering
from snapmill.sources.schemas import declared_columns

SOURCE_KEYS = ("CUST_ID", "SNAP_DT")


def _project(src: DataFrame, table: str, cfg: EntityConfig) -> DataFrame:
    """The declared columns of a RAW table, with the two source keys under their configured names."""
    rename = dict(zip(SOURCE_KEYS, cfg.pk, strict=True))
    return src.select(*[F.col(c).alias(rename.get(c, c)) for c in declared_columns("RAW", table)])


def raw_customer(src: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    return _project(src, "CUSTOMER", cfg)


def raw_account(src: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    return _project(src, "ACCOUNT", cfg)


def raw_events(src: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    return _project(src, "EVENTS", cfg)


def raw_purchases(src: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    return _project(src, "PURCHASES", cfg)


def ext_customer(raw: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Customer snapshot of one date."""
    return raw.where(F.col(cfg.dt_key) == dt_lit(d))


def ext_account(raw: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Account snapshot of one date."""
    return raw.where(F.col(cfg.dt_key) == dt_lit(d)).select(
        "ACCT_ID", *cfg.pk, "ACCT_TYPE_CD", "DR_AMT", "CR_AMT", "END_BAL", "CR_LMT")


def _happened_on(raw: DataFrame, ts: str, columns: list[str], d: date, cfg: EntityConfig,
                 prune_batches: bool) -> DataFrame:
    src = batches_covering(raw, d, d, cfg) if prune_batches else raw
    return (src.where(F.col(ts).cast("date") == dt_lit(d))
            .select(cfg.entity_key, dt_lit(d).alias(cfg.dt_key), *columns))


def ext_events(raw: DataFrame, d: date, cfg: EntityConfig = DEFAULT, prune_batches: bool = False) -> DataFrame:
    """Events that happened on d, whatever batch brought them, stamped with d."""
    return _happened_on(raw, "EVENT_TS", ["EVENT_TS", "EVENT_CHANNEL", "EVENT_CD"], d, cfg, prune_batches)


def ext_purchases(raw: DataFrame, d: date, cfg: EntityConfig = DEFAULT, prune_batches: bool = False) -> DataFrame:
    """Purchases that happened on d, stamped with d."""
    return _happened_on(raw, "PUR_TS", ["PUR_TS", "PUR_AMT", "PUR_NUM"], d, cfg, prune_batches)
