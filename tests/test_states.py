"""Mergeable states: numeric profiles over snapshots, features over days, and the calendar's sweep."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import D, SF, plan
from snapmill.config import days_between
from snapmill.operators import calendar as cal
from snapmill.operators import features as f
from snapmill.operators import profile as p
from snapmill.operators import states as st
from snapmill.plans.incremental import FeatureStates
from snapmill.runtime import materialize
from snapmill.sources import bindings as b


@pytest.fixture(scope="module")
def numbers(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 7).alias("d"), F.when(F.col("id") % 11 != 0, F.randn(1) * 3 + 100).alias("a"), F.exp(F.randn(2)).alias("b"), F.lit(5.0).alias("c"))
    odd = spark.createDataFrame([(0, float("nan"), float("inf"), 5.0), (3, 0.0, float("-inf"), 5.0)], "d long, a double, b double, c double")
    return materialize(df.unionByName(odd))


def values(df, *keys):
    return {tuple(r[k] for k in (*keys, "COLUMN", "STAT")): r.VALUE for r in df.collect()}


def test_merged_states_equal_the_whole(numbers):
    cols = ["a", "b", "c"]
    whole = values(st.state_profile(st.profile_states(numbers, cols)))
    parts = st.profile_states(numbers, cols, by=["d"])
    merged = values(st.state_profile(st.merge_states(parts)))
    exact = values(p.eda_numeric(numbers, cols))
    for key, v in merged.items():
        if key[1].startswith("P") and key[1] != "PRECISION":
            continue
        for other in (whole[key], exact[key]):
            if other is None or np.isnan(other):
                # without spread there is no skewness
                assert v is None and key[0] == "c"
            else:
                assert v == pytest.approx(other, rel=1e-8, abs=1e-8), key
    one = values(st.state_profile(st.merge_states(parts, ["d"]), ["d"], []), "d")
    assert one == values(st.state_profile(parts, ["d"], []), "d")


@pytest.mark.parametrize("k", [200, 1_600])
def test_sketched_quantiles_keep_their_bound(numbers, k):
    merged = st.merge_states(st.profile_states(numbers, ["a", "b"], k, ["d"]))
    got = values(st.state_profile(merged))
    for c in ("a", "b"):
        x = np.sort([r[0] for r in numbers.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))).select(c).collect()])
        for q in p.PROBS:
            v = got[c, f"P{round(q * 100):02d}"]
            low, high = np.searchsorted(x, v, "left") / len(x), np.searchsorted(x, v, "right") / len(x)
            assert low - st.RANK_ERROR[k] <= q <= high + st.RANK_ERROR[k], (c, q)


def test_states_come_from_one_aggregation(numbers):
    text = plan(st.profile_states(numbers, ["a", "b", "c"]))
    assert text.count("Scan parquet") == 2 and text.count("Exchange") <= 4  # each is named in the tree and in the details


def test_states_of_nothing(spark, numbers):
    empty = values(st.state_profile(st.profile_states(numbers.limit(0), ["a"])))
    assert empty["a", "TOTAL"] == 0 and empty["a", "MEAN"] is None and empty["a", "P50"] is None
    nulls = st.profile_states(spark.range(3).select(F.lit(None).cast("double").alias("a")), ["a"])
    both = values(st.state_profile(st.merge_states(nulls.unionByName(st.profile_states(numbers, ["a"])))))
    assert both["a", "MISSING"] == values(st.state_profile(st.profile_states(numbers, ["a"])))["a", "MISSING"] + 3


# --- features day by day

@pytest.fixture(scope="module")
def sources(spark):
    dates = days_between(D - timedelta(days=1), D + timedelta(days=1))
    return b.customer(spark, SF, dates), materialize(b.account(spark, SF)), materialize(b.events(spark, SF)), dates


def test_adding_days_equals_a_full_recomputation(spark, sources, tmp_path):
    customer, account, events, dates = sources
    # some events lie on midnights, where two windows meet
    events = events.withColumn("EVENT_TS", F.when(F.hash("EVENT_TS") % 5 == 0, F.date_trunc("day", "EVENT_TS")).otherwise(F.col("EVENT_TS")))
    states = FeatureStates(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError):
        states.features(customer, D)
    states.advance(days_between(D - timedelta(days=8), D - timedelta(days=2)), account, events)
    whole = f.features_range(customer, account, events, dates)
    for d in dates:
        states.add_day(d, account, events)
        got = states.features(customer, d)
        want = whole.where(F.col("SNAP_DT") == F.lit(d)).select(*got.columns)
        kinds = [F.col(c).cast(t).alias(c) for c, t in want.dtypes]
        assert got.count() == want.count() > 0
        assert got.select(*kinds).exceptAll(want).isEmpty() and want.exceptAll(got.select(*kinds)).isEmpty()
    # a day that arrives again replaces its own state
    before = states.features(customer, D).collect()
    states.add_day(D, account, events)
    assert sorted(states.features(customer, D).collect()) == sorted(before)


def test_a_new_day_reads_one_day(spark, sources, tmp_path):
    _, account, events, _ = sources
    account.write.partitionBy("SNAP_DT").parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    assert "PartitionFilters: [isnotnull(SNAP_DT" in plan(f.acct_base(stored, D))
    states = FeatureStates(spark, str(tmp_path / "s"))
    states.advance([D - timedelta(days=1), D], stored, events)
    assert states.accounts.count(D) == f.acct_base(account, D).count()
    assert "PartitionFilters: [isnotnull(SNAP_DT" in plan(states.event_window(D))


# --- the calendar's sweep

def test_the_sweep_equals_the_range_join(spark, monkeypatch):
    rng = random.Random(8)
    at, rows = datetime(2020, 1, 1), []
    for i in range(400):
        at += timedelta(hours=rng.choice([0, 6, 24, 24 * 9]))
        end = at + timedelta(hours=rng.choice([1, 12, 24, 36, 24 * 40]))
        rows.append((f"m{i}", at, end))
        at = end
    rows.append(("empty", at, at))
    rows.append(("open", at + timedelta(days=30), datetime(9999, 12, 31)))
    calendar = spark.createDataFrame(rows, "MODEL_ID string, START_TS timestamp_ntz, END_TS timestamp_ntz")
    days = [date(2019, 12, 20) + timedelta(days=i) for i in range(0, 12_000, 3)]
    dates = spark.createDataFrame([(i, d) for i, d in enumerate([*days, *days[:50], None])], "k int, d date")
    whole = {(r.k, r.d): r.MODEL_ID for r in cal.model_pick(dates, calendar, "d", "prod").collect()}
    monkeypatch.setattr(cal, "RANGE_ROWS", 0)
    swept = cal.model_pick(dates, calendar, "d", "prod")
    assert "Generate" not in plan(swept)
    assert {(r.k, r.d): r.MODEL_ID for r in swept.collect()} == whole
    assert len(whole) == len(days) + 51 and {"prod", "open"} < set(whole.values()) and "empty" not in whole.values()
    with pytest.raises(Exception):
        cal.model_pick(dates, calendar, "d").collect()
