"""Inputs shared by the registered queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.config import days_between
from snapmill.operators import features as f
from snapmill.operators.labels import joined_xy
from snapmill.runtime import folder_stamp, materialize, scratch_path, spread
from snapmill.sources import bindings as b
from snapmill.sources.store import SnapshotTable

D = b.REFERENCE_DATE
# every date that the event table holds
MANY = days_between(date(2024, 1, 1), date(2024, 1, 30))

_written: dict[tuple, object] = {}


def once(spark: SparkSession, key: tuple, make):
    """A value made once per application and state of the input folder, key[1]; for what several queries read."""
    full = (spark.sparkContext.applicationId, folder_stamp(spark, key[1]), *key)
    if full not in _written:
        _written[full] = make()
    return _written[full]


def account_table(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """The account snapshots as a partitioned table in the shared scratch folder."""
    def write() -> SnapshotTable:
        out = SnapshotTable(spark, scratch_path(spark, "account"))
        out.overwrite(b.account(spark, sf_dir))
        return out
    return once(spark, ("account", sf_dir), write)


def features_at(spark: SparkSession, sf_dir: str, d: date = D) -> DataFrame:
    cust = f.cust_base(b.customer(spark, sf_dir, [d]), d)
    recent = b.account(spark, sf_dir).where(F.col("SNAP_DT").between(F.lit(d - timedelta(days=6)), F.lit(d)))
    acct = f.acct_window(f.acct_base(recent), d)
    event = f.event_window(b.events(spark, sf_dir), d)
    return f.features(cust, acct, event, d)


def xy_at(spark: SparkSession, sf_dir: str, d: date = D) -> DataFrame:
    return joined_xy(features_at(spark, sf_dir, d), f.purchase_window(b.purchases(spark, sf_dir), d), [d])


def xy_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled features, written once for the queries that fit on them repeatedly."""
    return once(spark, ("xy", sf_dir), lambda: materialize(spread(xy_at(spark, sf_dir), "CUST_ID")))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and date over all dates, with a small stratum, for sampling."""
    def write() -> DataFrame:
        base = f.acct_base(b.account(spark, sf_dir))
        return materialize(base.select("CUST_ID", "SNAP_DT", F.least("NUM_ACCTS_DEB", F.lit(2)).alias("STRATUM")))
    return once(spark, ("panel", sf_dir), write)
