"""Building blocks of the checking SQL: named subqueries and the order they depend on each other."""

from __future__ import annotations

D = "DATE '2024-01-15'"

EVENT_BASE = """
SELECT *, cast(json_extract_string(props, '$.k') AS INTEGER) AS k, cast(value AS DECIMAL(12,2)) AS v,
       cast(ts AS DATE) AS day
FROM events"""

ACCTS = """
SELECT user_id AS CUST_ID, cast(event_id AS VARCHAR) AS ACCT_ID, day AS SNAP_DT,
       CASE event_type WHEN 'view' THEN 'CHQ' WHEN 'click' THEN 'SAV' WHEN 'purchase' THEN 'CRD'
            WHEN 'signup' THEN 'LN' ELSE 'MTG' END AS ACCT_TYPE_CD,
       v AS END_BAL, cast(v * (k % 10) AS DECIMAL(12,2)) AS DR_AMT, cast(v * (k % 7) AS DECIMAL(12,2)) AS CR_AMT,
       CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE cast(v * 2 + 100 AS DECIMAL(12,2)) END AS CR_LMT
FROM event_base"""

EVTS = """
SELECT user_id AS CUST_ID, day AS SNAP_DT, cast(ts AS TIMESTAMP) AS EVENT_TS,
       CASE WHEN k % 10 < 7 THEN 'E' ELSE 'P' END AS EVENT_CHANNEL,
       CASE event_type WHEN 'click' THEN 'C' WHEN 'error' THEN 'D' ELSE 'O' END AS EVENT_CD
FROM event_base WHERE event_type <> 'purchase'"""

PURS = """
SELECT user_id AS CUST_ID, day AS SNAP_DT, cast(ts AS TIMESTAMP) AS PUR_TS, cast(k % 14 + 1 AS BIGINT) AS PUR_NUM,
       cast(value AS DECIMAL(10,2)) AS PUR_AMT
FROM event_base WHERE event_type = 'purchase'"""

CUSTS_ALL = """
SELECT c_custkey AS CUST_ID, c_name AS NAME, CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS GENDER,
       cast(DATE '1960-01-01' + cast(c_custkey * 37 % 15000 AS INTEGER) AS DATE) AS BIRTH_DT,
       CASE WHEN c_custkey % 3 = 0 THEN '555-' || c_custkey END AS PHONE,
       CASE WHEN c_custkey % 11 <> 0 THEN 'u' || c_custkey || '@' || lower(c_mktsegment) || '.example' END AS EMAIL,
       CASE c_custkey % 9 WHEN 0 THEN 'A+' WHEN 1 THEN 'A-' WHEN 2 THEN 'AB+' WHEN 3 THEN 'AB-' WHEN 4 THEN 'B+'
            WHEN 5 THEN 'B-' WHEN 6 THEN 'O+' WHEN 7 THEN 'O-' END AS BLOOD_GRP,
       c_mktsegment AS JOB,
       CASE c_nationkey % 4 WHEN 0 THEN 'New York' WHEN 1 THEN ' Austin' WHEN 2 THEN 'Seattle' ELSE 'Chicago ' END AS OFFICE,
       'nation ' || c_nationkey AS ADDRESS,
       CASE c_custkey % 5 WHEN 0 THEN 'Sales' WHEN 1 THEN 'Devops' WHEN 2 THEN 'Platform' WHEN 3 THEN 'Product' END AS ORG,
       CASE c_custkey % 4 WHEN 0 THEN 'Engineer' WHEN 1 THEN 'Manager' WHEN 2 THEN 'VP' ELSE 'Associate' END AS TITLE,
       cast(DATE '2002-01-01' + cast(c_custkey * 53 % 8000 AS INTEGER) AS DATE) AS SINCE_DT,
       cast(greatest(c_acctbal, 0) AS DECIMAL(10,2)) AS SALARY,
       CASE WHEN c_custkey % 13 <> 0 THEN cast(cast(greatest(c_acctbal, 0) AS DECIMAL(10,2)) * (c_custkey % 3)
            AS DECIMAL(10,2)) END AS BONUS
FROM customer"""

CUSTS = f"SELECT *, {D} AS SNAP_DT FROM custs_all"

# several snapshots of every customer, for the many-dates queries
CUSTS_MANY = """
SELECT custs_all.*, cast(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS SNAP_DT
FROM custs_all"""


def cust_base_sql(src: str) -> str:
    return f"""
SELECT CUST_ID, SNAP_DT, GENDER,
       nullif(regexp_extract(coalesce(EMAIL, 'xx@NA'), '@(\\w+)', 1), '') AS EMAIL_DOMAIN, BLOOD_GRP,
       coalesce(trim(lower(OFFICE)) IN ('new york', 'los angeles', 'chicago'), false) AS SUPER_CITY,
       coalesce(trim(lower(OFFICE)) IN ('new york', 'seattle', 'los angeles'), false) AS COASTAL_CITY,
       coalesce(trim(lower(TITLE)) IN ('manager', 'senior manager', 'vp'), false) AS MANAGER_FLG,
       coalesce(trim(lower(ORG)) IN ('devops', 'internal tools', 'platform'), false) AS TECHNICAL_FLG,
       date_diff('year', BIRTH_DT, SNAP_DT) AS AGE, date_diff('year', SINCE_DT, SNAP_DT) AS TENURE,
       coalesce(SALARY, 0) + coalesce(BONUS, 0) AS TOTAL_COMP,
       cast(coalesce(cast(coalesce(BONUS, 0) AS DOUBLE) / nullif(cast(coalesce(SALARY, 0) + coalesce(BONUS, 0) AS DOUBLE), 0), 0)
            AS DECIMAL(18,2)) AS BONUS_RATIO
FROM {src}"""


ACCT_BASE = """
SELECT CUST_ID, SNAP_DT,
       count(DISTINCT row(ACCT_ID, ACCT_TYPE_CD, END_BAL, DR_AMT, CR_AMT, CR_LMT))
           FILTER (trim(ACCT_TYPE_CD) IN ('CHQ', 'SAV')) AS NUM_ACCTS_DEB,
       count(DISTINCT row(ACCT_ID, ACCT_TYPE_CD, END_BAL, DR_AMT, CR_AMT, CR_LMT))
           FILTER (trim(ACCT_TYPE_CD) NOT IN ('CHQ', 'SAV')) AS NUM_ACCTS_CRE,
       coalesce(sum(END_BAL) FILTER (trim(ACCT_TYPE_CD) IN ('CHQ', 'SAV')), 0) AS END_BAL_DEB,
       coalesce(sum(END_BAL) FILTER (trim(ACCT_TYPE_CD) NOT IN ('CHQ', 'SAV')), 0) AS END_BAL_CRE,
       coalesce(sum(DR_AMT) FILTER (trim(ACCT_TYPE_CD) IN ('CHQ', 'SAV')), 0) AS DR_AMT_DEB,
       coalesce(sum(DR_AMT) FILTER (trim(ACCT_TYPE_CD) NOT IN ('CHQ', 'SAV')), 0) AS DR_AMT_CRE,
       coalesce(sum(CR_AMT) FILTER (trim(ACCT_TYPE_CD) IN ('CHQ', 'SAV')), 0) AS CR_AMT_DEB,
       coalesce(sum(CR_AMT) FILTER (trim(ACCT_TYPE_CD) NOT IN ('CHQ', 'SAV')), 0) AS CR_AMT_CRE,
       coalesce(sum(CR_LMT) FILTER (trim(ACCT_TYPE_CD) NOT IN ('CHQ', 'SAV')), 0) AS CR_LMT
FROM accts GROUP BY CUST_ID, SNAP_DT"""


def acct_daily_sql(dates: str) -> str:
    """The densified grid: customers present at each AS_OF date x the seven days up to it."""
    return f"""
SELECT g.CUST_ID, g.AS_OF, g.DT,
       {', '.join(f'coalesce(b.{m}, 0) AS {m}' for m in (
           'NUM_ACCTS_DEB', 'NUM_ACCTS_CRE', 'END_BAL_DEB', 'END_BAL_CRE', 'DR_AMT_DEB', 'DR_AMT_CRE',
           'CR_AMT_DEB', 'CR_AMT_CRE', 'CR_LMT'))},
       coalesce(b.NUM_ACCTS_DEB, 0) + coalesce(b.NUM_ACCTS_CRE, 0) AS NUM_ACCTS,
       coalesce(b.DR_AMT_DEB, 0) - coalesce(b.CR_AMT_DEB, 0) AS TOTAL_DEB_FLOW,
       coalesce(b.CR_AMT_CRE, 0) - coalesce(b.DR_AMT_CRE, 0) AS TOTAL_CRE_FLOW,
       coalesce(b.DR_AMT_DEB, 0) - coalesce(b.CR_AMT_DEB, 0) + coalesce(b.CR_AMT_CRE, 0) - coalesce(b.DR_AMT_CRE, 0) AS TOTAL_FLOW
FROM (SELECT CUST_ID, SNAP_DT AS AS_OF,
             cast(unnest(generate_series(SNAP_DT - 6, SNAP_DT, INTERVAL 1 DAY)) AS DATE) AS DT
      FROM acct_base WHERE SNAP_DT IN ({dates})) g
LEFT JOIN acct_base b ON b.CUST_ID = g.CUST_ID AND b.SNAP_DT = g.DT"""


ACCT_WINDOW = """
SELECT CUST_ID, AS_OF AS SNAP_DT, max(NUM_ACCTS) AS MAX_NUM_ACCT_7D, sum(TOTAL_FLOW) AS TOTAL_FLOW_7D,
       coalesce(cast(sum(TOTAL_DEB_FLOW) AS DOUBLE) / nullif(cast(sum(TOTAL_CRE_FLOW) AS DOUBLE), 0), 0) AS DEB_CRE_FLOW_7D,
       coalesce(avg(cast(END_BAL_CRE AS DOUBLE)) / nullif(cast(max(CR_LMT) AS DOUBLE), 0), 0) AS AVG_CR_UTIL_7D,
       coalesce(cast(max(END_BAL_CRE) AS DOUBLE) / nullif(cast(max(CR_LMT) AS DOUBLE), 0), 0) AS MAX_CR_UTIL_7D,
       coalesce(cast(sum(DR_AMT_DEB) FILTER (DT >= AS_OF - 2) AS DOUBLE)
                / nullif(avg(cast(END_BAL_DEB AS DOUBLE)) FILTER (DT >= AS_OF - 2), 0), 0) AS AVG_DR_DEB_3D,
       coalesce(cast(sum(CR_AMT_DEB) FILTER (DT >= AS_OF - 2) AS DOUBLE)
                / nullif(avg(cast(END_BAL_DEB AS DOUBLE)) FILTER (DT >= AS_OF - 2), 0), 0) AS AVG_CR_DEB_3D,
       coalesce(cast(sum(DR_AMT_CRE) FILTER (DT >= AS_OF - 2) AS DOUBLE)
                / nullif(avg(cast(END_BAL_CRE AS DOUBLE)) FILTER (DT >= AS_OF - 2), 0), 0) AS AVG_DR_CRE_3D,
       coalesce(cast(sum(CR_AMT_CRE) FILTER (DT >= AS_OF - 2) AS DOUBLE)
                / nullif(avg(cast(END_BAL_CRE AS DOUBLE)) FILTER (DT >= AS_OF - 2), 0), 0) AS AVG_CR_CRE_3D
FROM acct_daily GROUP BY CUST_ID, AS_OF"""


def event_window_sql(dates: str) -> str:
    return f"""
SELECT e.CUST_ID, d.d AS SNAP_DT, date_diff('day', cast(max(EVENT_TS) AS DATE), d.d) AS DAYS_SINCE_LAST_EVENT,
       count(EVENT_TS) AS NUM_EVENT_7D,
       count(*) FILTER (trim(EVENT_CHANNEL) = 'E') / cast(count(EVENT_TS) AS DOUBLE) AS RATIO_EVENT_EMAIL,
       count(*) FILTER (trim(EVENT_CD) = 'C') / cast(count(EVENT_TS) AS DOUBLE) AS RATIO_EVENT_CLICK,
       count(*) FILTER (trim(EVENT_CD) = 'D') / cast(count(EVENT_TS) AS DOUBLE) AS RATIO_EVENT_DECLINE
FROM evts e JOIN (SELECT unnest([{dates}]) AS d) d
  ON e.EVENT_TS BETWEEN cast(d.d - 7 AS TIMESTAMP) AND cast(d.d AS TIMESTAMP)
GROUP BY e.CUST_ID, d.d"""


def purchase_window_sql(dates: str) -> str:
    return f"""
SELECT p.CUST_ID, d.d AS SNAP_DT, count(PUR_TS) AS NUM_PUR_F7D, cast(sum(PUR_NUM) AS BIGINT) AS TOTAL_PUR_NUM_F7D,
       sum(PUR_AMT) AS TOTAL_PUR_AMT_F7D
FROM purs p JOIN (SELECT unnest([{dates}]) AS d) d
  ON p.PUR_TS BETWEEN cast(d.d + 1 AS TIMESTAMP) AND cast(d.d + 8 AS TIMESTAMP)
GROUP BY p.CUST_ID, d.d"""


FEATURES = """
SELECT c.*, a.* EXCLUDE (CUST_ID, SNAP_DT), coalesce(e.DAYS_SINCE_LAST_EVENT, 0) AS DAYS_SINCE_LAST_EVENT,
       coalesce(e.NUM_EVENT_7D, 0) AS NUM_EVENT_7D, e.RATIO_EVENT_EMAIL, e.RATIO_EVENT_CLICK, e.RATIO_EVENT_DECLINE
FROM cust_base c
LEFT JOIN acct_window a ON a.CUST_ID = c.CUST_ID AND a.SNAP_DT = c.SNAP_DT
LEFT JOIN event_window e ON e.CUST_ID = c.CUST_ID AND e.SNAP_DT = c.SNAP_DT"""

POSITIVES = """
SELECT * FROM purchase_window
WHERE NUM_PUR_F7D > 1 AND (TOTAL_PUR_NUM_F7D > 5 OR TOTAL_PUR_AMT_F7D > 50)"""

XY = """
SELECT f.*, CASE WHEN p.CUST_ID IS NULL THEN 0 ELSE 1 END AS CONV_7D
FROM features f LEFT JOIN positives p ON p.CUST_ID = f.CUST_ID AND p.SNAP_DT = f.SNAP_DT"""

BLOCKS = {
    "event_base": EVENT_BASE, "accts": ACCTS, "evts": EVTS, "purs": PURS, "custs_all": CUSTS_ALL, "custs": CUSTS,
    "cust_base": cust_base_sql("custs"), "acct_base": ACCT_BASE, "acct_daily": acct_daily_sql(D),
    "acct_window": ACCT_WINDOW, "event_window": event_window_sql(D), "purchase_window": purchase_window_sql(D),
    "features": FEATURES, "positives": POSITIVES, "xy": XY,
}

NEEDS = {
    "accts": ["event_base"], "evts": ["event_base"], "purs": ["event_base"], "custs": ["custs_all"],
    "custs_many": ["custs_all"], "cust_base": ["custs"], "acct_base": ["accts"], "acct_daily": ["acct_base"],
    "acct_window": ["acct_daily"], "event_window": ["evts"], "purchase_window": ["purs"],
    "features": ["cust_base", "acct_window", "event_window"], "positives": ["purchase_window"],
    "xy": ["features", "positives"],
}

# columns of the numeric outputs, to state the final types once
INTS = {"AGE", "TENURE", "NUM_ACCTS_DEB", "NUM_ACCTS_CRE", "NUM_ACCTS", "MAX_NUM_ACCT_7D", "DAYS_SINCE_LAST_EVENT",
        "NUM_EVENT_7D", "NUM_PUR_F7D", "TOTAL_PUR_NUM_F7D", "CONV_7D"}
SAME = {"CUST_ID", "ACCT_ID", "SNAP_DT", "GENDER", "EMAIL_DOMAIN", "BLOOD_GRP", "SUPER_CITY", "COASTAL_CITY",
        "MANAGER_FLG", "TECHNICAL_FLG", "ACCT_TYPE_CD"}


def ctes(*names: str, extra: dict[str, str] | None = None) -> str:
    """WITH clause of the named blocks and everything they need; extra blocks replace or follow them."""
    extra = extra or {}
    blocks = {**BLOCKS, **extra}
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in NEEDS.get(name, []):
            add(need)
        ordered.append(name)

    for n in names:
        add(n)
    for n in extra:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({blocks[n]})" for n in ordered) + "\n"


def typed(columns: list[str], digits: int = 6, prefix: str = "") -> str:
    """Select list with the shared types: bigint, rounded double, or unchanged."""
    out = []
    for c in columns:
        if c in INTS:
            out.append(f"cast({prefix}{c} AS BIGINT) AS {c}")
        elif c in SAME:
            out.append(f"{prefix}{c}")
        else:
            out.append(f"round(cast({prefix}{c} AS DOUBLE), {digits}) + 0.0 AS {c}")
    return ", ".join(out)


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round(cast({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"


def u(key: str, seed: int = 0) -> str:
    """Hash-uniform number of a key."""
    return f"(cast('0x' || substr(md5({key} || '|{seed}'), 1, 8) AS BIGINT) / 4294967296.0)"
