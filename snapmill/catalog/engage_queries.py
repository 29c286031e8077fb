"""Engagement features, probabilities and roll-forward queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from snapmill.catalog.inputs import D, once
from snapmill.catalog.registry import query
from snapmill.catalog.sql import ctes, r, u
from snapmill.operators import engage as e
from snapmill.operators import rollforward as roll
from snapmill.runtime import materialize
from snapmill.operators.prep import enc_ordinal, fit_ordinal, fit_standardize, prep_binarize, prep_standardize
from snapmill.sources import bindings as b

DS = "DATE '2024-01-15'"

KEPT = ["GENDER", "BLOOD_GRP", "OFFICE", "ORG", "TITLE"]
NUMS = ["AGE", "TENURE", "TOTAL_COMP", "BONUS_RATIO"]
RATIOS = e.RATIOS
SIDES = [f"{n}_{s}" for s in ("DEB", "CRE") for n in ["NUM_ACCTS", *RATIOS, *e.SUMS]]
FLOWS = [*[f"{n}_{s}" for s in ("DEB", "CRE") for n in RATIOS if not (s == "DEB" and "UTIL" in n)],
         "NUM_ACCTS", "TOTAL_FLOW", "DEB_TO_CRE"]

CUST_FE = f"""
SELECT CUST_ID, SNAP_DT, GENDER, BLOOD_GRP, OFFICE, ORG, TITLE,
       date_diff('day', BIRTH_DT, SNAP_DT) / 365.0::DOUBLE AS AGE,
       date_diff('day', SINCE_DT, SNAP_DT) / 365.0::DOUBLE AS TENURE,
       cast(coalesce(SALARY, 0) + coalesce(BONUS, 0) AS DOUBLE) AS TOTAL_COMP,
       cast(coalesce(BONUS, 0) AS DOUBLE) / nullif(cast(coalesce(SALARY, 0) + coalesce(BONUS, 0) AS DOUBLE), 0) AS BONUS_RATIO
FROM custs WHERE SNAP_DT = {DS}"""

TWO_LEVEL = f"""
SELECT CUST_ID, DIRECTION, max(N) AS NUM_ACCTS, max(END_BAL) AS MAX_END_BAL,
       cast(sum(END_BAL) AS DOUBLE) / count(*) AS AVG_END_BAL, max(DR_AMT) AS MAX_DR_AMT, sum(DR_AMT) AS SUM_DR_AMT,
       max(CR_AMT) AS MAX_CR_AMT, sum(CR_AMT) AS SUM_CR_AMT, max(CR_LMT) AS MAX_CR_LMT
FROM (SELECT CUST_ID, CASE WHEN ACCT_TYPE_CD IN ('CHQ', 'SAV') THEN 'DR' ELSE 'CR' END AS DIRECTION, SNAP_DT,
             count(ACCT_ID) AS N, coalesce(sum(END_BAL), 0) AS END_BAL, coalesce(sum(DR_AMT), 0) AS DR_AMT,
             coalesce(sum(CR_AMT), 0) AS CR_AMT, coalesce(sum(CR_LMT), 0) AS CR_LMT
      FROM accts WHERE SNAP_DT BETWEEN {DS} - 6 AND {DS} GROUP BY 1, 2, 3)
GROUP BY CUST_ID, DIRECTION"""


def _div(a: str, b_: str) -> str:
    return f"cast({a} AS DOUBLE) / nullif(cast({b_} AS DOUBLE), 0)"


ACCT_RATIOS = f"""
SELECT CUST_ID, DIRECTION, NUM_ACCTS, {_div('AVG_END_BAL', 'MAX_CR_LMT')} AS CR_UTIL,
       {_div('MAX_END_BAL', 'MAX_CR_LMT')} AS MAX_CR_UTIL, {_div('SUM_DR_AMT', 'AVG_END_BAL')} AS TOTAL_DR_RATIO,
       {_div('MAX_DR_AMT', 'MAX_END_BAL')} AS MAX_DR_RATIO, {_div('SUM_CR_AMT', 'AVG_END_BAL')} AS TOTAL_CR_RATIO,
       {_div('MAX_CR_AMT', 'MAX_END_BAL')} AS MAX_CR_RATIO, SUM_DR_AMT, SUM_CR_AMT
FROM two_level"""

FULL_OUTER = f"""
SELECT coalesce(d.CUST_ID, c.CUST_ID) AS CUST_ID,
       {', '.join(f'd.{n} AS {n}_DEB, c.{n} AS {n}_CRE' for n in ['NUM_ACCTS', *RATIOS, *e.SUMS])}
FROM (SELECT * FROM acct_ratios WHERE DIRECTION = 'DR') d
FULL OUTER JOIN (SELECT * FROM acct_ratios WHERE DIRECTION = 'CR') c ON d.CUST_ID = c.CUST_ID"""

FLOW_SQL = f"""
SELECT CUST_ID, {', '.join(FLOWS[:-3])}, coalesce(NUM_ACCTS_DEB, 0) + coalesce(NUM_ACCTS_CRE, 0) AS NUM_ACCTS,
       coalesce(coalesce(SUM_DR_AMT_DEB, 0) - coalesce(SUM_CR_AMT_DEB, 0) + coalesce(SUM_CR_AMT_CRE, 0) - SUM_DR_AMT_CRE, 0) AS TOTAL_FLOW,
       {_div('coalesce(SUM_DR_AMT_DEB, 0) - coalesce(SUM_CR_AMT_DEB, 0)',
             'coalesce(SUM_CR_AMT_CRE, 0) - coalesce(SUM_DR_AMT_CRE, 0)')} AS DEB_TO_CRE
FROM sides"""

ENG_FE = f"""
SELECT c.CUST_ID, c.SNAP_DT, {', '.join(f"coalesce(c.{k}, '0') AS {k}" for k in KEPT)},
       {', '.join(f'coalesce(c.{k}, 0) AS {k}' for k in NUMS)}, {', '.join(f'coalesce(f.{k}, 0) AS {k}' for k in FLOWS)}
FROM cust_fe c LEFT JOIN flows f ON f.CUST_ID = c.CUST_ID"""

EVENT_FE = f"""
SELECT CUST_ID, {DS} AS SNAP_DT, count(*) AS NUM_EVENT,
       date_diff('day', max(cast(EVENT_TS AS DATE)), {DS}) AS DAYS_SINCE_LAST_EVENT,
       count(*) FILTER (EVENT_CHANNEL = 'E') AS NUM_ENGE_EMAIL, count(*) FILTER (EVENT_CHANNEL = 'P') AS NUM_ENGE_PHONE,
       count(*) FILTER (EVENT_CD = 'C') AS NUM_CLICK, count(*) FILTER (EVENT_CD = 'D') AS NUM_DECLINE,
       count(*) FILTER (EVENT_CD = 'O') AS NUM_OPEN
FROM evts WHERE SNAP_DT BETWEEN {DS} - 13 AND {DS}
  AND EVENT_TS BETWEEN cast({DS} - 6 AS TIMESTAMP) AND cast({DS} AS TIMESTAMP)
GROUP BY CUST_ID"""

BLOCKS = {"cust_fe": CUST_FE, "two_level": TWO_LEVEL, "acct_ratios": ACCT_RATIOS, "sides": FULL_OUTER,
          "flows": FLOW_SQL, "eng_fe": ENG_FE, "event_fe": EVENT_FE}


def _scaled_sql(src: str, cols: list[str]) -> str:
    parts = [f"(coalesce({c}, 0) - (SELECT avg({c}) FROM {src})) / coalesce(nullif((SELECT stddev_pop({c}) FROM {src}), 0), 1) AS {c}"
             for c in cols]
    return ", ".join(parts)


def _score_sql(model: dict) -> str:
    terms = [str(model["INTERCEPT"])]
    for name, w in model["COEF"].items():
        if isinstance(w, dict):
            whens = " ".join(f"WHEN '{c}' THEN {x}" for c, x in w.items())
            terms.append(f"(CASE {name} {whens} ELSE 0 END)")
        else:
            terms.append(f"{name} * ({w})")
    return f"1 / (1 + exp(-(cast({' + '.join(terms)} AS DOUBLE))))"


EVENT_NUMS = [c for c, w in e.EVENT_MODEL["COEF"].items() if not isinstance(w, dict) and c not in ("GENDER", "OFFICE", "TITLE")]
CONV_NUMS = list(e.CONVERSION_MODEL["COEF"])
PROBS = {
    "event_in": f"""
SELECT CUST_ID, CASE WHEN GENDER = 'M' THEN 1 ELSE 0 END AS GENDER, BLOOD_GRP, ORG,
       dense_rank() OVER (ORDER BY OFFICE) AS OFFICE, dense_rank() OVER (ORDER BY TITLE) AS TITLE,
       {_scaled_sql('eng_d', EVENT_NUMS)} FROM eng_d""",
    "conv_in": f"SELECT CUST_ID, {_scaled_sql('event_fe', CONV_NUMS)} FROM event_fe",
    "event_p": f"SELECT CUST_ID, {_score_sql(e.EVENT_MODEL)} AS EVENT_PROB FROM event_in",
    "conv_p": f"SELECT CUST_ID, {_score_sql(e.CONVERSION_MODEL)} AS CONV_PROB FROM conv_in",
    "blend": f"""
SELECT e.CUST_ID, e.EVENT_PROB, coalesce(c.CONV_PROB, 0) AS CONV_PROB,
       e.EVENT_PROB * coalesce(c.CONV_PROB, 0) + (1 - e.EVENT_PROB) * cast({e.NATURAL_CONV_PROB} AS DOUBLE) AS TOTAL_PROB
FROM event_p e LEFT JOIN conv_p c ON c.CUST_ID = e.CUST_ID""",
    "daily": "SELECT *, 1 - pow(1 - TOTAL_PROB, cast(1 AS DOUBLE) / 7) AS DAILY_PROB FROM blend",
}
ENG_D = ", ".join(f"cast({c} AS DOUBLE) AS {c}" for c in EVENT_NUMS)
PROBS = {"eng_d": f"SELECT CUST_ID, GENDER, BLOOD_GRP, ORG, OFFICE, TITLE, {ENG_D} FROM eng_fe", **PROBS}


def _with(*names: str) -> str:
    """The blocks up to the last of names."""
    chain = {**BLOCKS, **PROBS}
    last = max(list(chain).index(n) for n in names)
    return ctes("custs", "accts", "evts", extra=dict(list(chain.items())[:last + 1]))


def _r(cols: list[str], digits: int = 6) -> str:
    return ", ".join(r(c, c, digits) for c in cols)


def two_level(spark, sf):
    return e.eng_acct_two_level(b.account(spark, sf), D)


def ratios(spark, sf):
    return e.eng_acct_ratios(two_level(spark, sf))


def eng_features(spark, sf):
    return e.eng_fe(e.eng_cust_fe(b.customer(spark, sf), D), e.eng_flows(e.eng_sides(ratios(spark, sf))))


@query("eng_cust_fe", _with("cust_fe") + f"SELECT CUST_ID, SNAP_DT, {', '.join(KEPT)}, {_r(NUMS)} FROM cust_fe")
def q_cust_fe(spark, sf):
    return e.eng_cust_fe(b.customer(spark, sf), D)


LEVELS = ["MAX_END_BAL", "AVG_END_BAL", "MAX_DR_AMT", "SUM_DR_AMT", "MAX_CR_AMT", "SUM_CR_AMT", "MAX_CR_LMT"]


@query("eng_acct_two_level", _with("two_level") + f"SELECT CUST_ID, DIRECTION, NUM_ACCTS, {_r(LEVELS)} FROM two_level")
def q_two_level(spark, sf):
    return two_level(spark, sf)


@query("eng_acct_ratios", _with("acct_ratios") + f"SELECT CUST_ID, DIRECTION, NUM_ACCTS, {_r([*RATIOS, *e.SUMS])} FROM acct_ratios")
def q_ratios(spark, sf):
    return ratios(spark, sf)


SIDES_SQL = f"SELECT CUST_ID, NUM_ACCTS_DEB, NUM_ACCTS_CRE, {_r([c for c in SIDES if not c.startswith('NUM_ACCTS')])} FROM sides"


@query("eng_full_outer", _with("sides") + SIDES_SQL)
def q_full_outer(spark, sf):
    return e.eng_full_outer(ratios(spark, sf))


@query("eng_sides", _with("sides") + SIDES_SQL)
def q_sides(spark, sf):
    return e.eng_sides(ratios(spark, sf))


FLOW_OUT = _r([c for c in FLOWS if c != "NUM_ACCTS"])


@query("eng_flows", _with("flows") + f"SELECT CUST_ID, NUM_ACCTS, {FLOW_OUT} FROM flows")
def q_flows(spark, sf):
    return e.eng_flows(e.eng_sides(ratios(spark, sf)))


@query("eng_fe", _with("eng_fe") + f"SELECT CUST_ID, SNAP_DT, {', '.join(KEPT)}, {_r(NUMS)}, NUM_ACCTS, {FLOW_OUT} FROM eng_fe")
def q_eng_fe(spark, sf):
    return eng_features(spark, sf)


@query("eng_event_fe", _with("event_fe") + "SELECT CUST_ID, SNAP_DT, NUM_EVENT, DAYS_SINCE_LAST_EVENT FROM event_fe")
def q_event_fe(spark, sf):
    return e.eng_event_fe(b.events(spark, sf), D)


@query("eng_event_pivot", _with("event_fe") + "SELECT * FROM event_fe")
def q_event_pivot(spark, sf):
    return e.eng_event_pivot(b.events(spark, sf), D)


def event_probs(spark, sf):
    """Event model over standardised numbers, a 0/1 gender and ordinal office and title."""
    # four fits read the features, so they are written once
    fe = once(spark, ("eng_fe", sf), lambda: materialize(eng_features(spark, sf).drop("SNAP_DT")))
    coded = prep_binarize(fe, ["GENDER"], ["M"])
    for c in ("OFFICE", "TITLE"):
        coded = enc_ordinal(coded, c, fit_ordinal(fe, c), c + "_CODE").drop(c).withColumnRenamed(c + "_CODE", c)
    scaled = prep_standardize(coded, fit_standardize(fe, EVENT_NUMS))
    return e.linear_score(scaled, e.EVENT_MODEL, "EVENT_PROB").select("CUST_ID", "EVENT_PROB")


def conv_probs(spark, sf):
    fe = once(spark, ("event_fe", sf), lambda: materialize(e.eng_event_pivot(b.events(spark, sf), D)))
    scaled = prep_standardize(fe, fit_standardize(fe, CONV_NUMS))
    return e.linear_score(scaled, e.CONVERSION_MODEL, "CONV_PROB").select("CUST_ID", "CONV_PROB")


def blended(spark, sf):
    return e.prob_blend(event_probs(spark, sf), conv_probs(spark, sf))


@query("linear_score", _with("event_p") + f"SELECT CUST_ID, {_r(['EVENT_PROB'])} FROM event_p")
def q_linear_score(spark, sf):
    return event_probs(spark, sf)


@query("prob_blend", _with("blend") + f"SELECT CUST_ID, {_r(['EVENT_PROB', 'CONV_PROB', 'TOTAL_PROB'])} FROM blend")
def q_prob_blend(spark, sf):
    return blended(spark, sf)


@query("daily_prob", _with("daily") + f"SELECT CUST_ID, {_r(['EVENT_PROB', 'CONV_PROB', 'TOTAL_PROB', 'DAILY_PROB'])} FROM daily")
def q_daily_prob(spark, sf):
    return e.daily_prob(blended(spark, sf), "TOTAL_PROB")


@query("event_expand", _with("daily") + f"""
SELECT CUST_ID, {DS} AS SNAP_DT, cast(EVENT_DAY AS BIGINT) AS EVENT_DAY, cast({DS} + cast(EVENT_DAY + 1 AS INTEGER) AS DATE) AS EVENT_DT
FROM (SELECT CUST_ID, DAILY_PROB, unnest(range(7)) AS EVENT_DAY FROM daily)
WHERE {u("concat_ws('|', CUST_ID, EVENT_DAY)", 3)} <= DAILY_PROB""")
def q_event_expand(spark, sf):
    return e.event_expand(e.daily_prob(blended(spark, sf), "TOTAL_PROB"), "DAILY_PROB", D, seed=3).drop("DAILY_PROB")


def _custs_with_ids_of_accounts(spark, sf):
    """The customer snapshot at d. Accounts belong to the first customers only."""
    return b.customer(spark, sf).select("CUST_ID", "SNAP_DT", "GENDER", "TITLE")


def _accts(spark, sf, d):
    return b.account(spark, sf).where(F.col("SNAP_DT") == F.lit(d))


ROLL_CUST = "SELECT CUST_ID, SNAP_DT, GENDER, TITLE FROM custs"
ACCT_OUT = f"CUST_ID, ACCT_ID, SNAP_DT, ACCT_TYPE_CD, {', '.join(r(c, c, 2) for c in ('END_BAL', 'DR_AMT', 'CR_AMT', 'CR_LMT'))}"


@query("roll_new_custs", ctes("custs", "accts") + ROLL_CUST + f" WHERE CUST_ID NOT IN (SELECT CUST_ID FROM accts WHERE SNAP_DT = {DS} - 1)")
def q_roll_new(spark, sf):
    return roll.roll_new_custs(_custs_with_ids_of_accounts(spark, sf), _accts(spark, sf, D - timedelta(days=1)))


@query("roll_keep_custs", ctes("custs", "accts") + f"SELECT {ACCT_OUT} FROM accts WHERE CUST_ID IN (SELECT CUST_ID FROM custs WHERE CUST_ID % 3 <> 0)", digits=2)
def q_roll_keep(spark, sf):
    return roll.roll_keep_custs(b.account(spark, sf), _custs_with_ids_of_accounts(spark, sf).where("CUST_ID % 3 <> 0"))


@query("roll_drop_custs", ctes("custs") + ROLL_CUST + f" WHERE CUST_ID NOT IN (SELECT CUST_ID FROM custs ORDER BY {u('CUST_ID', 2)}, CUST_ID LIMIT 5)")
def q_roll_drop(spark, sf):
    return roll.roll_drop_custs(_custs_with_ids_of_accounts(spark, sf), 5, seed=2)


@query("roll_forward", ctes("custs", "accts") + f"""
SELECT CUST_ID, ACCT_ID, {DS} AS SNAP_DT, ACCT_TYPE_CD, {r('END_BAL', 'END_BAL', 2)} FROM accts WHERE SNAP_DT = {DS} - 1
UNION ALL
SELECT CUST_ID, 'N' || CUST_ID, {DS}, 'CHQ', 0.0 FROM custs
WHERE CUST_ID NOT IN (SELECT CUST_ID FROM accts WHERE SNAP_DT = {DS} - 1)""", digits=2)
def q_roll_forward(spark, sf):
    """Yesterday's accounts re-stamped, and an opening account for every new customer."""
    last = _accts(spark, sf, D - timedelta(days=1)).select("CUST_ID", "ACCT_ID", "SNAP_DT", "ACCT_TYPE_CD", "END_BAL")
    new = roll.roll_new_custs(_custs_with_ids_of_accounts(spark, sf), last).select(
        "CUST_ID", F.concat(F.lit("N"), F.col("CUST_ID").cast("string")).alias("ACCT_ID"), "SNAP_DT",
        F.lit("CHQ").alias("ACCT_TYPE_CD"), F.lit(0).cast("decimal(12,2)").alias("END_BAL"))
    return roll.roll_forward(last, D, new)
