"""Customer features (X) and the purchase target (y).

Time windows compare timestamps with dates, so both ends include the midnight instant:
events of [d-7 00:00, d 00:00], purchases of [d+1 00:00, d+8 00:00].
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import (
    clean, day_number, dt_lit, email_domain, flag_in, ratio_or_null, ratio_or_zero, years_apart, zero_if_null,
)

# fixed values: place, title and department names that set the membership flags, and the account
# types that count as deposits (all others are credit)
SUPER_CITIES = ["new york", "los angeles", "chicago"]
COASTAL_CITIES = ["new york", "seattle", "los angeles"]
MANAGER_TITLES = ["manager", "senior manager", "vp"]
TECHNICAL_ORGS = ["devops", "internal tools", "platform"]
DEPOSIT_TYPES = ["CHQ", "SAV"]

LONG_DAYS = 7
SHORT_DAYS = 3

CUST_FEATURES = ["GENDER", "EMAIL_DOMAIN", "BLOOD_GRP", "SUPER_CITY", "COASTAL_CITY", "MANAGER_FLG",
                 "TECHNICAL_FLG", "AGE", "TENURE", "TOTAL_COMP", "BONUS_RATIO"]
ACCT_FEATURES = ["MAX_NUM_ACCT_7D", "TOTAL_FLOW_7D", "DEB_CRE_FLOW_7D", "AVG_CR_UTIL_7D", "MAX_CR_UTIL_7D",
                 "AVG_DR_DEB_3D", "AVG_CR_DEB_3D", "AVG_DR_CRE_3D", "AVG_CR_CRE_3D"]
EVENT_FEATURES = ["DAYS_SINCE_LAST_EVENT", "NUM_EVENT_7D", "RATIO_EVENT_EMAIL", "RATIO_EVENT_CLICK",
                  "RATIO_EVENT_DECLINE"]
ACCT_MEASURES = ["NUM_ACCTS_DEB", "NUM_ACCTS_CRE", "END_BAL_DEB", "END_BAL_CRE", "DR_AMT_DEB", "DR_AMT_CRE",
                 "CR_AMT_DEB", "CR_AMT_CRE", "CR_LMT"]


def _on_dates(df: DataFrame, dt_key: str, dates: date | Iterable[date]) -> DataFrame:
    if isinstance(dates, date):
        return df.where(F.col(dt_key) == dt_lit(dates))
    return df.where(F.col(dt_key).isin(list(dates)))


def cust_base(customer: DataFrame, dates: date | Iterable[date], cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Customer attributes and membership flags at the given snapshot date(s)."""
    snap = F.col(cfg.dt_key)
    salary, bonus = zero_if_null("SALARY"), zero_if_null("BONUS")
    return _on_dates(customer, cfg.dt_key, dates).select(
        *cfg.pk,
        "GENDER",
        email_domain("EMAIL").alias("EMAIL_DOMAIN"),
        "BLOOD_GRP",
        flag_in(clean("OFFICE"), SUPER_CITIES).alias("SUPER_CITY"),
        flag_in(clean("OFFICE"), COASTAL_CITIES).alias("COASTAL_CITY"),
        flag_in(clean("TITLE"), MANAGER_TITLES).alias("MANAGER_FLG"),
        flag_in(clean("ORG"), TECHNICAL_ORGS).alias("TECHNICAL_FLG"),
        years_apart(F.col("BIRTH_DT"), snap).alias("AGE"),
        years_apart(F.col("SINCE_DT"), snap).alias("TENURE"),
        (salary + bonus).alias("TOTAL_COMP"),
        ratio_or_zero(bonus, salary + bonus).cast("decimal(18,2)").alias("BONUS_RATIO"),
    )


def acct_base(account: DataFrame, dates: date | Iterable[date] | None = None,
              cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Per customer and date: account counts and balances split into deposit and credit.

    An account is a distinct row, while amounts are summed over all rows. Identical rows are
    folded first with their multiplicity; that step is keyed by the whole row, so a customer
    with very many accounts is spread over all tasks, and the second aggregation receives
    map-side partial sums.
    """
    acct = account if dates is None else _on_dates(account, cfg.dt_key, dates)
    measures = ["END_BAL", "DR_AMT", "CR_AMT", "CR_LMT"]
    rows = (acct.groupBy(*cfg.pk, "ACCT_ID", "ACCT_TYPE_CD", *measures)
            .agg(F.count(F.lit(1)).alias("COPIES")))
    kind = F.trim("ACCT_TYPE_CD").isin(DEPOSIT_TYPES)

    def total(measure: str, keep: Column) -> Column:
        amount = F.col(measure) * F.col("COPIES").cast("decimal(10,0)")
        return F.coalesce(F.sum(F.when(keep, amount)), F.lit(0)).cast("decimal(22,2)")

    return rows.groupBy(*cfg.pk).agg(
        F.count_if(kind).alias("NUM_ACCTS_DEB"),
        F.count_if(~kind).alias("NUM_ACCTS_CRE"),
        total("END_BAL", kind).alias("END_BAL_DEB"),
        total("END_BAL", ~kind).alias("END_BAL_CRE"),
        total("DR_AMT", kind).alias("DR_AMT_DEB"),
        total("DR_AMT", ~kind).alias("DR_AMT_CRE"),
        total("CR_AMT", kind).alias("CR_AMT_DEB"),
        total("CR_AMT", ~kind).alias("CR_AMT_CRE"),
        total("CR_LMT", ~kind).alias("CR_LMT"),
    )


def acct_grid(base: DataFrame, d: date, history: int = LONG_DAYS, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Every customer present at d, once for each of the trailing days."""
    days = F.sequence(dt_lit(d), dt_lit(d - timedelta(days=history - 1)), F.expr("interval -1 day"))
    return (base.where(F.col(cfg.dt_key) == dt_lit(d))
            .select(cfg.entity_key, F.explode(days).alias(cfg.dt_key)))


def _flows() -> dict[str, Column]:
    deb = F.col("DR_AMT_DEB") - F.col("CR_AMT_DEB")
    cre = F.col("CR_AMT_CRE") - F.col("DR_AMT_CRE")
    return {
        "NUM_ACCTS": F.col("NUM_ACCTS_DEB") + F.col("NUM_ACCTS_CRE"),
        "TOTAL_DEB_FLOW": deb,
        "TOTAL_CRE_FLOW": cre,
        "TOTAL_FLOW": deb + cre,
    }


def acct_daily(base: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """The customer grid filled with each day's account measures, zero where a day has none."""
    window = base.where(F.col(cfg.dt_key).between(dt_lit(d - timedelta(days=LONG_DAYS - 1)), dt_lit(d)))
    filled = acct_grid(base, d, cfg=cfg).join(window, cfg.pk, "left").select(
        *cfg.pk, *[zero_if_null(m).alias(m) for m in ACCT_MEASURES])
    return filled.withColumns(_flows())


def _window_ratios() -> list[Column]:
    """The nine trailing features from the sums and maxima of the last 7 and 3 days."""
    avg_bal_7d = F.col("S7_END_BAL_CRE").cast("double") / LONG_DAYS
    avg_deb_3d = F.col("S3_END_BAL_DEB").cast("double") / SHORT_DAYS
    avg_cre_3d = F.col("S3_END_BAL_CRE").cast("double") / SHORT_DAYS
    return [
        F.col("M7_NUM_ACCTS").alias("MAX_NUM_ACCT_7D"),
        F.col("S7_TOTAL_FLOW").alias("TOTAL_FLOW_7D"),
        ratio_or_zero(F.col("S7_TOTAL_DEB_FLOW"), F.col("S7_TOTAL_CRE_FLOW")).alias("DEB_CRE_FLOW_7D"),
        ratio_or_zero(avg_bal_7d, F.col("M7_CR_LMT")).alias("AVG_CR_UTIL_7D"),
        ratio_or_zero(F.col("M7_END_BAL_CRE"), F.col("M7_CR_LMT")).alias("MAX_CR_UTIL_7D"),
        ratio_or_zero(F.col("S3_DR_AMT_DEB"), avg_deb_3d).alias("AVG_DR_DEB_3D"),
        ratio_or_zero(F.col("S3_CR_AMT_DEB"), avg_deb_3d).alias("AVG_CR_DEB_3D"),
        ratio_or_zero(F.col("S3_DR_AMT_CRE"), avg_cre_3d).alias("AVG_DR_CRE_3D"),
        ratio_or_zero(F.col("S3_CR_AMT_CRE"), avg_cre_3d).alias("AVG_CR_CRE_3D"),
    ]


_MAX_7D = ["NUM_ACCTS", "END_BAL_CRE", "CR_LMT"]
_SUM_7D = ["TOTAL_FLOW", "TOTAL_DEB_FLOW", "TOTAL_CRE_FLOW", "END_BAL_CRE"]
_SUM_3D = ["DR_AMT_DEB", "CR_AMT_DEB", "END_BAL_DEB", "DR_AMT_CRE", "CR_AMT_CRE", "END_BAL_CRE"]


def _max_over_grid(max_value: Column, n_rows: Column) -> Column:
    """Maximum over seven days of which the missing ones count as zero."""
    return F.when(n_rows < LONG_DAYS, F.greatest(max_value, F.lit(0))).otherwise(max_value)


def acct_window(base: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Trailing 7- and 3-day account features of the customers present at d.

    Date-conditional sums over the at most seven base rows per customer: one shuffle on the
    entity, no densified grid and no collected arrays.
    """
    snap = F.col(cfg.dt_key)
    recent = snap >= dt_lit(d - timedelta(days=SHORT_DAYS - 1))
    rows = (base.where(snap.between(dt_lit(d - timedelta(days=LONG_DAYS - 1)), dt_lit(d)))
            .withColumns(_flows()))
    sums = rows.groupBy(cfg.entity_key).agg(
        F.count(F.lit(1)).alias("N_ROWS"),
        F.max(snap == dt_lit(d)).alias("PRESENT"),
        *[F.max(c).alias(f"M7_{c}") for c in _MAX_7D],
        *[F.sum(c).alias(f"S7_{c}") for c in _SUM_7D],
        *[F.coalesce(F.sum(F.when(recent, F.col(c))), F.lit(0)).alias(f"S3_{c}") for c in _SUM_3D],
    ).where("PRESENT")
    zero_filled = {f"M7_{c}": _max_over_grid(F.col(f"M7_{c}"), F.col("N_ROWS")) for c in _MAX_7D}
    return sums.withColumns(zero_filled).select(
        cfg.entity_key, dt_lit(d).alias(cfg.dt_key), *_window_ratios())


def _event_ratios() -> list[Column]:
    n = F.col("NUM_EVENT_7D")
    return [
        n.alias("NUM_EVENT_7D"),
        ratio_or_null(F.col("N_EMAIL"), n).alias("RATIO_EVENT_EMAIL"),
        ratio_or_null(F.col("N_CLICK"), n).alias("RATIO_EVENT_CLICK"),
        ratio_or_null(F.col("N_DECLINE"), n).alias("RATIO_EVENT_DECLINE"),
    ]


def _event_counts() -> list[Column]:
    return [
        F.count("EVENT_TS").alias("NUM_EVENT_7D"),
        F.count_if(F.trim("EVENT_CHANNEL") == "E").alias("N_EMAIL"),
        F.count_if(F.trim("EVENT_CD") == "C").alias("N_CLICK"),
        F.count_if(F.trim("EVENT_CD") == "D").alias("N_DECLINE"),
    ]


def batches_covering(df: DataFrame, first: date, last: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Keep the batches that can hold event days first..last.

    For feeds whose batch b covers the days b+1..b+7 this prunes whole partitions; it must not
    be used for any other layout.
    """
    snap = F.col(cfg.dt_key)
    return df.where(snap.between(dt_lit(first - timedelta(days=7)), dt_lit(last - timedelta(days=1))))


def event_window(events: DataFrame, d: date, cfg: EntityConfig = DEFAULT, prune_batches: bool = False) -> DataFrame:
    """Engagement of the trailing seven days per customer."""
    first = d - timedelta(days=7)
    src = batches_covering(events, first, d, cfg) if prune_batches else events
    return (src.where(F.col("EVENT_TS").between(dt_lit(first), dt_lit(d)))
            .groupBy(cfg.entity_key)
            .agg(F.max("EVENT_TS").alias("LAST_TS"), *_event_counts())
            .select(cfg.entity_key, dt_lit(d).alias(cfg.dt_key),
                    F.datediff(dt_lit(d), F.col("LAST_TS").cast("date")).alias("DAYS_SINCE_LAST_EVENT"),
                    *_event_ratios()))


def purchase_window(purchases: DataFrame, d: date, cfg: EntityConfig = DEFAULT,
                    prune_batches: bool = False) -> DataFrame:
    """Purchases of the seven days after d per customer (the target's raw measures)."""
    first, last = d + timedelta(days=1), d + timedelta(days=8)
    src = batches_covering(purchases, first, last, cfg) if prune_batches else purchases
    return (src.where(F.col("PUR_TS").between(dt_lit(first), dt_lit(last)))
            .groupBy(cfg.entity_key)
            .agg(F.count("PUR_TS").alias("NUM_PUR_F7D"),
                 F.sum("PUR_NUM").alias("TOTAL_PUR_NUM_F7D"),
                 F.sum("PUR_AMT").alias("TOTAL_PUR_AMT_F7D"))
            .select(cfg.entity_key, dt_lit(d).alias(cfg.dt_key),
                    "NUM_PUR_F7D", "TOTAL_PUR_NUM_F7D", "TOTAL_PUR_AMT_F7D"))


def _select_features(joined: DataFrame, cfg: EntityConfig, extra: list[Column] | None = None) -> DataFrame:
    return joined.select(
        *cfg.pk, *CUST_FEATURES, *ACCT_FEATURES,
        zero_if_null("DAYS_SINCE_LAST_EVENT").alias("DAYS_SINCE_LAST_EVENT"),
        zero_if_null("NUM_EVENT_7D").alias("NUM_EVENT_7D"),
        "RATIO_EVENT_EMAIL", "RATIO_EVENT_CLICK", "RATIO_EVENT_DECLINE", *(extra or []))


def features(cust: DataFrame, acct: DataFrame, event: DataFrame, d: date, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Customer, account and event features of one date, one row per customer.

    All three inputs are cut to the same date, so the joins are on the entity alone and keep
    the partitioning the aggregations already have.
    """
    def at_d(df: DataFrame) -> DataFrame:
        return df.where(F.col(cfg.dt_key) == dt_lit(d))

    joined = (at_d(cust)
              .join(at_d(acct).drop(cfg.dt_key), cfg.entity_key, "left")
              .join(at_d(event).drop(cfg.dt_key), cfg.entity_key, "left"))
    return _select_features(joined, cfg)


def _daily_with_midnight(df: DataFrame, ts: str, aggs: list[Column], names: list[str],
                         cfg: EntityConfig) -> DataFrame:
    """Per entity and day: the aggregates over the whole day and over its midnight instant."""
    at_midnight = F.col(ts) == F.date_trunc("day", F.col(ts))
    return (df.groupBy(cfg.entity_key, F.col(ts).cast("date").alias(cfg.dt_key), at_midnight.alias("MIDNIGHT"))
            .agg(*aggs)
            .groupBy(cfg.entity_key, cfg.dt_key)
            .agg(*[F.sum(n).alias(n) for n in names],
                 *[F.sum(F.when(F.col("MIDNIGHT"), F.col(n))).alias(f"MID_{n}") for n in names]))


def features_range(customer: DataFrame, account: DataFrame, events: DataFrame, dates: Iterable[date],
                   purchases: DataFrame | None = None, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Features (and, with purchases, the target measures) of many dates in one job.

    Every source is first reduced to one row per entity and day. Those rows and an empty one per wanted
    date are stacked into one timeline per entity, shuffled once, and range frames over the day number
    give all trailing and forward windows. Only entities with any row in a source have a timeline; the
    customers' attributes stay out of it and meet its finished columns in one join on entity and date, so
    a customer without activity costs no window. An entity has at most four rows per day, so a very active
    one cannot make a window partition large.
    """
    dates = sorted(set(dates))
    lo, hi = dates[0], dates[-1]
    account = account.where(F.col(cfg.dt_key).between(dt_lit(lo - timedelta(days=6)), dt_lit(hi)))
    events = events.where(F.col("EVENT_TS").between(dt_lit(lo - timedelta(days=7)), dt_lit(hi)))
    sources = [account, events]
    if purchases is not None:
        purchases = purchases.where(F.col("PUR_TS").between(dt_lit(lo + timedelta(days=1)), dt_lit(hi + timedelta(days=8))))
        sources.append(purchases)
    seen = sources[0].select(cfg.entity_key)
    for source in sources[1:]:
        seen = seen.union(source.select(cfg.entity_key))
    wanted = seen.distinct().select(cfg.entity_key, F.explode(F.array(*[dt_lit(d) for d in dates])).alias(cfg.dt_key), F.lit(True).alias("IS_WANTED"))
    acct = acct_base(account, cfg=cfg).withColumns(_flows()).withColumn("IS_ACCT", F.lit(1))
    event_names = ["NUM_EVENT_7D", "N_EMAIL", "N_CLICK", "N_DECLINE"]
    parts = [wanted, acct, _daily_with_midnight(events, "EVENT_TS", _event_counts(), event_names, cfg)]
    pur_names = ["NUM_PUR_F7D", "TOTAL_PUR_NUM_F7D", "TOTAL_PUR_AMT_F7D"]
    if purchases is not None:
        parts.append(_daily_with_midnight(
            purchases, "PUR_TS",
            [F.count("PUR_TS").alias("NUM_PUR_F7D"), F.sum("PUR_NUM").alias("TOTAL_PUR_NUM_F7D"),
             F.sum("PUR_AMT").alias("TOTAL_PUR_AMT_F7D")], pur_names, cfg))
    timeline = parts[0]
    for part in parts[1:]:
        timeline = timeline.unionByName(part, allowMissingColumns=True)
    day = day_number(cfg.dt_key)
    timeline = timeline.withColumn("DAY", day)

    by_day = Window.partitionBy(cfg.entity_key).orderBy("DAY")
    w7, w3, w0 = by_day.rangeBetween(-6, 0), by_day.rangeBetween(-2, 0), by_day.rangeBetween(0, 0)
    past, ahead, last_day = by_day.rangeBetween(-7, -1), by_day.rangeBetween(1, 7), by_day.rangeBetween(8, 8)

    def both(name: str, whole, edge) -> Column:
        return F.coalesce(F.sum(name).over(whole), F.lit(0)) + F.coalesce(F.sum(f"MID_{name}").over(edge), F.lit(0))

    is_event_day = F.when(F.col("NUM_EVENT_7D") > 0, F.col("DAY"))
    is_event_midnight = F.when(F.col("MID_NUM_EVENT_7D") > 0, F.col("DAY"))
    computed = {
        "N_ROWS": F.sum("IS_ACCT").over(w7),
        "PRESENT": F.max("IS_ACCT").over(w0),
        **{f"M7_{c}": F.max(c).over(w7) for c in _MAX_7D},
        **{f"S7_{c}": F.sum(c).over(w7) for c in _SUM_7D},
        **{f"S3_{c}": F.coalesce(F.sum(c).over(w3), F.lit(0)) for c in _SUM_3D},
        **{f"E_{n}": both(n, past, w0) for n in event_names},
        "E_LAST_DAY": F.greatest(F.max(is_event_day).over(past), F.max(is_event_midnight).over(w0)),
    }
    if purchases is not None:
        computed |= {f"P_{n}": both(n, ahead, last_day) for n in pur_names}
    rows = timeline.select("*", *[c.alias(n) for n, c in computed.items()]).where("IS_WANTED")

    rows = rows.withColumns({
        **{n: F.when(F.col(f"E_{n}") > 0, F.col(f"E_{n}")) if n == "NUM_EVENT_7D" else F.col(f"E_{n}")
           for n in event_names},
        **{f"M7_{c}": _max_over_grid(F.col(f"M7_{c}"), F.col("N_ROWS")) for c in _MAX_7D},
        "DAYS_SINCE_LAST_EVENT": F.col("DAY") - F.col("E_LAST_DAY"),
    })
    present = F.col("PRESENT") == 1
    acct_cols = [F.when(present, c).alias(n) for n, c in zip(ACCT_FEATURES, _window_ratios(), strict=True)]
    event_cols = _event_ratios()
    extra = [f"P_{n}" for n in pur_names] if purchases is not None else []
    active = rows.select(*cfg.pk, *acct_cols, "DAYS_SINCE_LAST_EVENT", *event_cols, *extra)
    joined = cust_base(customer, dates, cfg).join(active, cfg.pk, "left")
    return _select_features(joined, cfg, [F.coalesce(f"P_{n}", F.lit(0)).alias(n) for n in pur_names] if extra else [])
