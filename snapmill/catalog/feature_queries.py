"""Feature, target, label, sampling and splitting queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from snapmill.catalog import sql as q
from snapmill.catalog.inputs import D, MANY, features_at, panel, xy_at
from snapmill.catalog.registry import query
from snapmill.catalog.sql import ctes, typed, u
from snapmill.operators import features as f
from snapmill.config import days_between
from snapmill.operators import labels, sampling
from snapmill.plans import incremental
from snapmill.plans.training import make_training_set
from snapmill.runtime import scratch_path
from snapmill.sources import bindings as b

DS = "DATE '2024-01-15'"
CUST_COLS = ["CUST_ID", "SNAP_DT", *f.CUST_FEATURES]
BASE_COLS = ["CUST_ID", "SNAP_DT", *f.ACCT_MEASURES]
WINDOW_COLS = ["CUST_ID", "SNAP_DT", *f.ACCT_FEATURES]
EVENT_COLS = ["CUST_ID", "SNAP_DT", *f.EVENT_FEATURES]
FEATURE_COLS = ["CUST_ID", "SNAP_DT", *f.CUST_FEATURES, *f.ACCT_FEATURES, *f.EVENT_FEATURES]
TARGET_COLS = ["NUM_PUR_F7D", "TOTAL_PUR_NUM_F7D", "TOTAL_PUR_AMT_F7D"]


@query("cust_base", ctes("cust_base") + f"SELECT {typed(CUST_COLS)} FROM cust_base")
def cust_base(spark, sf):
    return f.cust_base(b.customer(spark, sf), D)


@query("acct_base", ctes("acct_base") + f"SELECT {typed(BASE_COLS)} FROM acct_base")
def acct_base(spark, sf):
    return f.acct_base(b.account(spark, sf))


@query("acct_grid", ctes("acct_daily") + "SELECT CUST_ID, DT AS SNAP_DT FROM acct_daily")
def acct_grid(spark, sf):
    return f.acct_grid(f.acct_base(b.account(spark, sf)), D)


DAILY_COLS = [*f.ACCT_MEASURES, "NUM_ACCTS", "TOTAL_DEB_FLOW", "TOTAL_CRE_FLOW", "TOTAL_FLOW"]


@query("acct_daily", ctes("acct_daily") + f"SELECT CUST_ID, DT AS SNAP_DT, {typed(DAILY_COLS)} FROM acct_daily")
def acct_daily(spark, sf):
    return f.acct_daily(f.acct_base(b.account(spark, sf)), D)


@query("acct_window", ctes("acct_window") + f"SELECT {typed(WINDOW_COLS)} FROM acct_window")
def acct_window(spark, sf):
    return f.acct_window(f.acct_base(b.account(spark, sf)), D)


@query("event_window", ctes("event_window") + f"SELECT {typed(EVENT_COLS)} FROM event_window")
def event_window(spark, sf):
    return f.event_window(b.events(spark, sf), D)


@query("features", ctes("features") + f"SELECT {typed(FEATURE_COLS)} FROM features")
def features(spark, sf):
    return features_at(spark, sf)


@query("purchase_window", ctes("purchase_window") + f"SELECT {typed(['CUST_ID', 'SNAP_DT', *TARGET_COLS])} FROM purchase_window")
def purchase_window(spark, sf):
    return f.purchase_window(b.purchases(spark, sf), D)


MANY_SQL = ", ".join(f"DATE '{d}'" for d in MANY)
RANGE_BLOCKS = ctes("custs_all", "acct_base", "evts", "purs", extra={
    "custs_many": q.CUSTS_MANY,
    "cust_base": q.cust_base_sql("custs_many"),
    "acct_daily": q.acct_daily_sql(MANY_SQL),
    "acct_window": q.ACCT_WINDOW,
    "event_window": q.event_window_sql(MANY_SQL),
    "purchase_window": q.purchase_window_sql(MANY_SQL),
    "features": q.FEATURES,
})
RANGE_SQL = RANGE_BLOCKS + f"""
SELECT {typed(FEATURE_COLS, prefix='f.')}, {', '.join(
    f'cast(coalesce(p.{c}, 0) AS BIGINT) AS {c}' if c != 'TOTAL_PUR_AMT_F7D' else q.r(f'coalesce(p.{c}, 0)', c) for c in TARGET_COLS)}
FROM features f LEFT JOIN purchase_window p ON p.CUST_ID = f.CUST_ID AND p.SNAP_DT = f.SNAP_DT"""


@query("features_range", RANGE_SQL)
def features_range(spark, sf):
    return f.features_range(b.customer(spark, sf, MANY), b.account(spark, sf), b.events(spark, sf), MANY,
                            b.purchases(spark, sf))


STEPPED = days_between(D, D + timedelta(days=2))
STEPPED_SQL = RANGE_BLOCKS + f"SELECT {typed(FEATURE_COLS)} FROM features WHERE SNAP_DT BETWEEN DATE '{STEPPED[0]}' AND DATE '{STEPPED[-1]}'"


@query("features_incremental", STEPPED_SQL)
def features_incremental(spark, sf):
    """Three dates from stored day states: each adds its own day to the states of the days before."""
    states = incremental.FeatureStates(spark, scratch_path(spark, "states"))
    account, events, customer = b.account(spark, sf), b.events(spark, sf), b.customer(spark, sf, STEPPED)
    states.advance(days_between(STEPPED[0] - timedelta(days=7), STEPPED[0] - timedelta(days=1)), account, events)
    out = None
    for d in STEPPED:
        states.add_day(d, account, events)
        rows = states.features(customer, d)
        out = rows if out is None else out.unionByName(rows)
    return out


@query("label_rule", ctes("positives") + f"SELECT {typed(['CUST_ID', 'SNAP_DT', *TARGET_COLS])} FROM positives")
def label_rule(spark, sf):
    return labels.label_rule(f.purchase_window(b.purchases(spark, sf), D))


@query("joined_xy", ctes("xy") + f"SELECT {typed([*FEATURE_COLS, 'CONV_7D'])} FROM xy")
def joined_xy(spark, sf):
    return xy_at(spark, sf)


@query("label_counts", ctes("xy") + "SELECT cast(CONV_7D AS BIGINT) AS CONV_7D, count(*) AS N_ROWS FROM xy GROUP BY 1")
def label_counts(spark, sf):
    return labels.label_counts(xy_at(spark, sf))


PANEL = ctes("acct_base", extra={
    "panel": "SELECT CUST_ID, SNAP_DT, cast(least(NUM_ACCTS_DEB, 2) AS BIGINT) AS STRATUM FROM acct_base"})
KEY = "concat_ws('|', CUST_ID, SNAP_DT)"


def _ranked(frac: float, seed: int) -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY STRATUM ORDER BY {u(KEY, seed)}, {KEY})
          <= round(count(*) OVER (PARTITION BY STRATUM) * cast({frac} AS DECIMAL(18,9))) AS IS_PICKED FROM panel"""


@query("sample_simple", PANEL + f"SELECT * FROM panel WHERE {u(KEY)} < 0.25")
def sample_simple(spark, sf):
    return sampling.sample_simple(panel(spark, sf), 0.25)


@query("sample_stratify", PANEL + f"SELECT CUST_ID, SNAP_DT, STRATUM FROM ({_ranked(0.25, 0)}) WHERE IS_PICKED")
def sample_stratify(spark, sf):
    return sampling.sample_stratify(panel(spark, sf), 0.25, "STRATUM")


@query("split_simple", PANEL + f"SELECT *, {u(KEY, 1)} < 0.8 AS IS_PICKED FROM panel")
def split_simple(spark, sf):
    return sampling.mark_simple(panel(spark, sf), 0.8, seed=1)


@query("split_stratify", PANEL + _ranked(0.8, 1))
def split_stratify(spark, sf):
    return sampling.mark_stratify(panel(spark, sf), 0.8, "STRATUM", seed=1)


@query("split_group", PANEL + f"SELECT *, {u('CUST_ID', 1)} < 0.8 AS IS_PICKED FROM panel")
def split_group(spark, sf):
    return sampling.mark_group(panel(spark, sf), 0.8, seed=1)


@query("split_timeseries", PANEL + """
, days AS (SELECT SNAP_DT, count(*) AS n FROM panel GROUP BY SNAP_DT),
shares AS (SELECT SNAP_DT, sum(n) OVER (ORDER BY SNAP_DT) AS seen, sum(n) OVER () AS total FROM days),
cutoff AS (SELECT min(SNAP_DT) AS d FROM shares WHERE seen >= 0.8 * total)
SELECT panel.*, SNAP_DT <= cutoff.d AS IS_PICKED FROM panel, cutoff""")
def split_timeseries(spark, sf):
    return sampling.mark_timeseries(panel(spark, sf), 0.8)


XY_KEY = KEY
TRAINING_SQL = ctes("xy") + f"""
, sampled AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CONV_7D ORDER BY {u(XY_KEY)}, {XY_KEY}) AS rk,
                        round(count(*) OVER (PARTITION BY CONV_7D) * cast(0.25 AS DECIMAL(18,9))) AS n_keep FROM xy)
  WHERE rk <= n_keep)
SELECT CUST_ID, SNAP_DT, cast(CONV_7D AS BIGINT) AS CONV_7D, {u('CUST_ID', 1)} < 0.8 AS IS_TRAIN FROM sampled"""


@query("make_training_set", TRAINING_SQL)
def q_make_training_set(spark, sf):
    train, test = make_training_set(features_at(spark, sf), f.purchase_window(b.purchases(spark, sf), D), [D])
    cols = ["CUST_ID", "SNAP_DT", "CONV_7D"]
    return (train.select(*cols, F.lit(True).alias("IS_TRAIN"))
            .unionByName(test.select(*cols, F.lit(False).alias("IS_TRAIN"))))
