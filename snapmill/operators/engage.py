"""Engagement features, event features and event probabilities."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig, past_days
from snapmill.functions.exprs import (
    daily_from_weekly, dt_lit, hash_uniform, logistic, ratio_or_null, zero_if_null,
)
from snapmill.operators.features import DEPOSIT_TYPES

# fixed values: columns left out of the engagement features, the probability of a purchase
# without engagement, and the days and batches the windows span
DROPPED = ["JOB", "EMAIL", "PHONE", "NAME", "ADDRESS", "BIRTH_DT", "SINCE_DT", "SALARY", "BONUS"]
NATURAL_CONV_PROB = 0.015
ACCT_HISTORY = 7
EVENT_BATCHES = 14

# fixed values: coefficients of the two scoring models
EVENT_MODEL = {
    "INTERCEPT": -3.0,
    "COEF": {
        "GENDER": 0.11,
        "BLOOD_GRP": {"A+": 0.21, "AB+": 0.15, "AB-": 0.13, "B+": 0.25, "B-": -0.15, "O+": 0.12, "O-": -0.11},
        "OFFICE": 0.09,
        "ORG": {"Devops": -0.13, "Internal Tools": 0.15, "Platform": 0.11, "Product": -0.25, "Sales": -0.42},
        "TITLE": -0.21,
        "AGE": 0.24,
        "TENURE": -0.16,
        "TOTAL_COMP": 0.43,
        "BONUS_RATIO": 0.78,
        "TOTAL_DR_RATIO_DEB": -0.17,
        "MAX_DR_RATIO_DEB": -0.14,
        "TOTAL_CR_RATIO_DEB": -0.32,
        "MAX_CR_RATIO_DEB": -0.15,
        "CR_UTIL_CRE": 0.57,
        "MAX_CR_UTIL_CRE": 0.25,
        "TOTAL_DR_RATIO_CRE": 0.21,
        "MAX_DR_RATIO_CRE": 0.09,
        "TOTAL_CR_RATIO_CRE": 0.22,
        "MAX_CR_RATIO_CRE": 0.14,
        "NUM_ACCTS": 0.27,
        "TOTAL_FLOW": 0.15,
        "DEB_TO_CRE": -0.14,
    },
}
CONVERSION_MODEL = {
    "INTERCEPT": -2.0,
    "COEF": {
        "DAYS_SINCE_LAST_EVENT": -1.2,
        "NUM_EVENT": 1.7,
        "NUM_ENGE_EMAIL": 1.21,
        "NUM_ENGE_PHONE": 1.5,
        "NUM_CLICK": 1.3,
        "NUM_DECLINE": -5.0,
        "NUM_OPEN": 0.2,
    },
}

RATIOS = ["CR_UTIL", "MAX_CR_UTIL", "TOTAL_DR_RATIO", "MAX_DR_RATIO", "TOTAL_CR_RATIO", "MAX_CR_RATIO"]
SUMS = ["SUM_DR_AMT", "SUM_CR_AMT"]


def eng_cust_fe(customer: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Customer attributes at d; age and tenure in fractions of a 365-day year."""
    salary, bonus = zero_if_null("SALARY"), zero_if_null("BONUS")
    snap = F.col(cfg.dt_key)
    return customer.where(snap == dt_lit(d)).withColumns({
        "AGE": F.datediff(snap, "BIRTH_DT") / 365.0,
        "TENURE": F.datediff(snap, "SINCE_DT") / 365.0,
        "TOTAL_COMP": salary + bonus,
        "BONUS_RATIO": ratio_or_null(bonus, salary + bonus),
    }).drop(*DROPPED)


def eng_acct_two_level(account: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Per customer and direction: maxima, means and sums of the daily totals of seven days.

    Both aggregations have map-side partials; after the first there are at most seven rows per
    customer and direction.
    """
    direction = F.when(F.col("ACCT_TYPE_CD").isin(DEPOSIT_TYPES), "DR").otherwise("CR")
    daily = (account.where(F.col(cfg.dt_key).isin(past_days(d, ACCT_HISTORY)))
             .groupBy(cfg.entity_key, direction.alias("DIRECTION"), cfg.dt_key)
             .agg(F.count("ACCT_ID").alias("N"),
                  *[zero_if_null(F.sum(c)).alias(c) for c in ("END_BAL", "DR_AMT", "CR_AMT", "CR_LMT")]))
    return daily.groupBy(cfg.entity_key, "DIRECTION").agg(
        F.max("N").alias("NUM_ACCTS"),
        F.max("END_BAL").alias("MAX_END_BAL"),
        (F.sum("END_BAL").cast("double") / F.count("END_BAL")).alias("AVG_END_BAL"),
        F.max("DR_AMT").alias("MAX_DR_AMT"),
        F.sum("DR_AMT").alias("SUM_DR_AMT"),
        F.max("CR_AMT").alias("MAX_CR_AMT"),
        F.sum("CR_AMT").alias("SUM_CR_AMT"),
        F.max("CR_LMT").alias("MAX_CR_LMT"),
    )


def eng_acct_ratios(two_level: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Utilisation and turnover ratios per customer and direction; null on a zero denominator."""
    c = F.col
    return two_level.select(
        cfg.entity_key, "DIRECTION", "NUM_ACCTS",
        ratio_or_null(c("AVG_END_BAL"), c("MAX_CR_LMT")).alias("CR_UTIL"),
        ratio_or_null(c("MAX_END_BAL"), c("MAX_CR_LMT")).alias("MAX_CR_UTIL"),
        ratio_or_null(c("SUM_DR_AMT"), c("AVG_END_BAL")).alias("TOTAL_DR_RATIO"),
        ratio_or_null(c("MAX_DR_AMT"), c("MAX_END_BAL")).alias("MAX_DR_RATIO"),
        ratio_or_null(c("SUM_CR_AMT"), c("AVG_END_BAL")).alias("TOTAL_CR_RATIO"),
        ratio_or_null(c("MAX_CR_AMT"), c("MAX_END_BAL")).alias("MAX_CR_RATIO"),
        *SUMS,
    )


def _side(ratios: DataFrame, direction: str, suffix: str, cfg: EntityConfig) -> DataFrame:
    names = ["NUM_ACCTS", *RATIOS, *SUMS]
    return ratios.where(F.col("DIRECTION") == direction).select(
        cfg.entity_key, *[F.col(n).alias(f"{n}_{suffix}") for n in names])


def eng_full_outer(ratios: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Deposit and credit sides of each customer beside each other, by a full outer join."""
    return _side(ratios, "DR", "DEB", cfg).join(_side(ratios, "CR", "CRE", cfg), cfg.entity_key, "full_outer")


def eng_sides(ratios: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """The same table as eng_full_outer by one conditional aggregation: one shuffle, no join."""
    names = ["NUM_ACCTS", *RATIOS, *SUMS]
    return ratios.groupBy(cfg.entity_key).agg(*[
        F.max(F.when(F.col("DIRECTION") == direction, F.col(n))).alias(f"{n}_{suffix}")
        for direction, suffix in (("DR", "DEB"), ("CR", "CRE")) for n in names])


def eng_flows(sides: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Totals over both sides. A customer without a credit side has TOTAL_FLOW 0."""
    dr_deb, cr_deb = zero_if_null("SUM_DR_AMT_DEB"), zero_if_null("SUM_CR_AMT_DEB")
    dr_cre, cr_cre = zero_if_null("SUM_DR_AMT_CRE"), zero_if_null("SUM_CR_AMT_CRE")
    flow = dr_deb - cr_deb + cr_cre - F.col("SUM_DR_AMT_CRE")
    kept = [f"{n}_{s}" for s in ("DEB", "CRE") for n in RATIOS if not (s == "DEB" and "UTIL" in n)]
    return sides.select(
        cfg.entity_key, *kept,
        (zero_if_null("NUM_ACCTS_DEB") + zero_if_null("NUM_ACCTS_CRE")).alias("NUM_ACCTS"),
        zero_if_null(flow).alias("TOTAL_FLOW"),
        ratio_or_null(dr_deb - cr_deb, cr_cre - dr_cre).alias("DEB_TO_CRE"),
    )


def assert_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """df unchanged; raises when a key occurs twice. One aggregation that is mostly map-side."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{what}: {keys} is not unique")
    return df


def eng_fe(cust: DataFrame, flows: DataFrame, cfg: EntityConfig = DEFAULT, validate: bool = True) -> DataFrame:
    """Customer features with account features, one to one; numeric nulls become 0."""
    if validate:
        # flows is grouped by the entity, so only the customer side can repeat it
        assert_unique(cust, [cfg.entity_key], "customer features")
    return cust.join(flows, cfg.entity_key, "left").na.fill(0).na.fill("0")


def window_events(events: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Events of [d-6 00:00, d 00:00] found in the batches d-13..d."""
    return events.where(F.col(cfg.dt_key).isin(past_days(d, EVENT_BATCHES))
                        & F.col("EVENT_TS").between(dt_lit(d - timedelta(days=6)), dt_lit(d)))


def eng_event_fe(events: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Number of events and days since the last one."""
    day = F.col("EVENT_TS").cast("date")
    return (window_events(events, d, cfg).groupBy(cfg.entity_key)
            .agg(F.count(day).alias("NUM_EVENT"), F.max(day).alias("LATEST"))
            .select(cfg.entity_key, "NUM_EVENT", dt_lit(d).alias(cfg.dt_key),
                    F.datediff(dt_lit(d), "LATEST").alias("DAYS_SINCE_LAST_EVENT")))


# fixed values: count columns per channel and per event code
CHANNEL_COUNTS = {"E": "NUM_ENGE_EMAIL", "P": "NUM_ENGE_PHONE"}
CODE_COUNTS = {"C": "NUM_CLICK", "D": "NUM_DECLINE", "O": "NUM_OPEN"}


def eng_event_pivot(events: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Event features with one count column per channel and per event code.

    The categories are fixed, so both pivots are conditional counts of the aggregation that also
    gives the totals: one scan and one shuffle instead of three of each and two joins.
    """
    day = F.col("EVENT_TS").cast("date")
    counts = [F.count_if(F.col(column) == value).alias(name)
              for column, names in (("EVENT_CHANNEL", CHANNEL_COUNTS), ("EVENT_CD", CODE_COUNTS))
              for value, name in names.items()]
    return (window_events(events, d, cfg).groupBy(cfg.entity_key)
            .agg(F.count(day).alias("NUM_EVENT"), F.max(day).alias("LATEST"), *counts)
            .select(cfg.entity_key, "NUM_EVENT", dt_lit(d).alias(cfg.dt_key),
                    F.datediff(dt_lit(d), "LATEST").alias("DAYS_SINCE_LAST_EVENT"),
                    *CHANNEL_COUNTS.values(), *CODE_COUNTS.values()))


def linear_score(df: DataFrame, model: dict, out: str = "PROB", noise: float = 0.0, seed: int | None = None,
                 key: list[str] | None = None) -> DataFrame:
    """Logistic score of a coefficient table over prepared columns.

    A nested coefficient table holds one weight per category of its column. Noise, a uniform
    draw per row times noise, needs a seed and the key columns it is drawn from.
    """
    z: Column = F.lit(float(model["INTERCEPT"]))
    for name, w in model["COEF"].items():
        if isinstance(w, dict):
            term = F.lit(0.0)
            for category, cw in w.items():
                term = F.when(F.col(name) == category, float(cw)).otherwise(term)
        else:
            term = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(w))
        z = z + term
    if noise:
        if seed is None or not key:
            raise ValueError("noise needs a seed and key columns")
        z = z + F.lit(noise) * hash_uniform(F.concat_ws("|", *key), seed)
    return df.withColumn(out, logistic(z))


def daily_prob(df: DataFrame, prob: str, out: str = "DAILY_PROB") -> DataFrame:
    return df.withColumn(out, daily_from_weekly(F.col(prob)))


def prob_blend(event_probs: DataFrame, conv_probs: DataFrame, natural: float = NATURAL_CONV_PROB,
               cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Purchase probability: engaged customers follow the conversion model, the rest the natural rate.

    Inputs have EVENT_PROB and CONV_PROB per customer; a missing CONV_PROB counts as 0.
    """
    joined = event_probs.join(conv_probs.select(cfg.entity_key, "CONV_PROB"), cfg.entity_key, "left")
    p_e, p_c = F.col("EVENT_PROB"), F.coalesce("CONV_PROB", F.lit(0.0))
    return joined.select(cfg.entity_key, p_e, p_c.alias("CONV_PROB"),
                         (p_e * p_c + (F.lit(1.0) - p_e) * F.lit(natural)).alias("TOTAL_PROB"))


def event_expand(probs: DataFrame, daily: str, d: date, seed: int = 0, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Customer-days among the seven after d whose hash draw is at most the daily probability."""
    days = probs.select(cfg.entity_key, daily, F.explode(F.sequence(F.lit(0), F.lit(6))).alias("EVENT_DAY"))
    draw = hash_uniform(F.concat_ws("|", F.col(cfg.entity_key).cast("string"), F.col("EVENT_DAY").cast("string")), seed)
    return days.where(draw <= F.col(daily)).select(
        cfg.entity_key, dt_lit(d).alias(cfg.dt_key), "EVENT_DAY",
        F.date_add(dt_lit(d), F.col("EVENT_DAY") + 1).alias("EVENT_DT"))
