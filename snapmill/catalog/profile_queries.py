"""Profiling and preprocessing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmill.catalog.inputs import xy_written
from snapmill.catalog.registry import query
from snapmill.catalog.sql import ctes, r
from snapmill.operators import prep
from snapmill.operators import profile as p
from snapmill.operators import states as st
from snapmill.sources.bindings import table

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
QUANTILES = [(f"P{round(x * 100):02d}", x) for x in p.PROBS]


def lineitem(spark, sf):
    return table(spark, sf, "lineitem")


def _counts_sql(src: str, columns: dict[str, str], extra: str = "") -> str:
    """TOTAL, MISSING and COUNT:<value> rows of {name: expression}."""
    parts = []
    for name, expr in columns.items():
        parts.append(f"SELECT '{name}' AS \"COLUMN\", 'TOTAL' AS STAT, cast(count(*) AS DOUBLE) AS VALUE{extra} FROM {src}")
        parts.append(f"SELECT '{name}', 'MISSING', cast(count(*) FILTER ({expr} IS NULL) AS DOUBLE){extra} FROM {src}")
        parts.append(f"SELECT '{name}', 'COUNT:' || cast({expr} AS VARCHAR), cast(count(*) AS DOUBLE){extra} FROM {src} "
                     f"WHERE {expr} IS NOT NULL GROUP BY 2")
    return "\nUNION ALL\n".join(parts)


BINARY_SQL = {"l_linestatus": "CASE WHEN l_linestatus IS NULL THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 0 END"}


@query("eda_binary", _counts_sql("lineitem", BINARY_SQL))
def eda_binary(spark, sf):
    return p.eda_binary(lineitem(spark, sf), ["l_linestatus"], ["F"])


@query("eda_nominal", _counts_sql("orders", {"o_orderpriority": "o_orderpriority", "o_orderstatus": "o_orderstatus"}))
def eda_nominal(spark, sf):
    return p.eda_nominal(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
POSITION = "CASE " + " ".join(f"WHEN STAT = 'COUNT:{c}' THEN {i}" for i, c in enumerate(PRIORITIES)) + \
    " WHEN STAT LIKE 'COUNT:%' THEN -1 END"


@query("eda_ordinal", f"SELECT *, cast({POSITION} AS BIGINT) AS POSITION FROM ("
       + _counts_sql("orders", {"o_orderpriority": "o_orderpriority"}) + ")")
def eda_ordinal(spark, sf):
    return p.eda_ordinal(table(spark, sf, "orders"), "o_orderpriority", PRIORITIES)


def numeric_sql(src: str, name: str, expr: str, digits: int, extra: str = "") -> str:
    """All statistics of one numeric column as (COLUMN, STAT, VALUE) rows."""
    n = p.N_BINS
    stats = [("TOTAL", "n"), ("MISSING", "missing"), ("ZEROS", "zeros"), ("INFS_POS", "0"), ("INFS_NEG", "0"),
             ("MEAN", "m"), ("STD", "s"), ("SKEW", "m3 / pow(sp, 3)"), ("KURT", "m4 / pow(sp, 4) - 3"),
             ("MIN", "lo"), ("MAX", "hi"), *[(k, f"q[{i + 1}]") for i, (k, _) in enumerate(QUANTILES)],
             ("XTREME", "n_low + n_high"), ("XTREME_LOW", "n_low"), ("XTREME_LOW_MEAN", "mean_low"),
             ("XTREME_HIGH", "n_high"), ("XTREME_HIGH_MEAN", "mean_high")]
    stats += [(f"EDGE_{i:02d}", f"lo + {i} * (hi - lo) / {n}") for i in range(n)]
    one = ", ".join(f"{{'s': '{k}', 'v': cast({v} AS DOUBLE)}}" for k, v in stats)
    base = f"(SELECT cast({expr} AS DOUBLE) AS x FROM {src})"
    a = f"""(SELECT count(*) AS n, count(*) FILTER (x IS NULL) AS missing, count(*) FILTER (x = 0) AS zeros, avg(x) AS m,
        stddev_samp(x) AS s, stddev_pop(x) AS sp, min(x) AS lo, max(x) AS hi,
        quantile_cont(x, [{', '.join(str(q) for _, q in QUANTILES)}]) AS q FROM {base})"""
    second = f"""(SELECT avg(pow(x - m, 3)) AS m3, avg(pow(x - m, 4)) AS m4,
        count(*) FILTER (x < m - 3 * s) AS n_low, count(*) FILTER (x > m + 3 * s) AS n_high,
        avg(x) FILTER (x < m - 3 * s) AS mean_low, avg(x) FILTER (x > m + 3 * s) AS mean_high FROM {base}, {a})"""
    hist = f"""
SELECT '{name}', 'HIST_' || lpad(cast(i AS VARCHAR), 2, '0'), cast(coalesce(c, 0) AS DOUBLE){extra}
FROM range({n}) g(i) LEFT JOIN (
  SELECT least(cast(floor((x - lo) / ((hi - lo) / {n})) AS BIGINT), {n - 1}) AS bin, count(*) AS c
  FROM {base}, {a} WHERE x IS NOT NULL GROUP BY 1) h ON h.bin = i"""
    return f"""
SELECT '{name}' AS "COLUMN", u.s AS STAT, round(u.v, {digits}) + 0.0 AS VALUE{extra}
FROM (SELECT unnest([{one}]) AS u FROM {a}, {second}) UNION ALL {hist}"""


@query("eda_numeric", "\nUNION ALL\n".join(
    [numeric_sql("lineitem", c, c, 4) for c in ("l_quantity", "l_extendedprice")]
    + [numeric_sql("lineitem", f"LOG:{c}", f"CASE WHEN {c} > 0 THEN ln({c}) END", 4) for c in ("l_quantity", "l_extendedprice")]), digits=4)
def eda_numeric(spark, sf):
    return p.eda_numeric(lineitem(spark, sf), ["l_quantity", "l_extendedprice"], p.NumericAttr(log_scale=True))


STATE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _state_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "COLUMN", unnest([{", ".join(
        f"{{'s': '{k}', 'v': cast({e} AS DOUBLE)}}" for k, e in {
            "TOTAL": "count(*)", "MISSING": f"count(*) - count({c})", "ZEROS": f"count(*) FILTER ({c} = 0)", "INFS_POS": "0", "INFS_NEG": "0",
            "MEAN": f"avg(cast({c} AS DOUBLE))", "MIN": f"min({c})", "MAX": f"max({c})", "STD": f"stddev_samp({c})"}.items())}]) AS u FROM lineitem"""


@query("eda_states", " UNION ALL ".join(f'SELECT "COLUMN", u.s AS STAT, round(u.v, 4) + 0.0 AS VALUE FROM ({_state_sql(c)})' for c in STATE_COLS), digits=4)
def eda_states(spark, sf):
    """States of each ship month, merged to the whole table; the quantiles are approximate and tested apart."""
    monthly = st.profile_states(lineitem(spark, sf).withColumn("MONTH", F.date_format("l_shipdate", "yyyy-MM")), STATE_COLS, by=["MONTH"])
    return st.state_profile(st.merge_states(monthly), probs=[]).where("STAT NOT IN ('SKEW', 'KURT')")


GUESS = {"l_orderkey": "num", "l_linenumber": "num", "l_quantity": "num", "l_returnflag": "txt", "l_linestatus": "txt",
         "l_shipdate": "other", "l_discount": "num"}


@query("guess_dtype", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "COLUMN", CASE WHEN n = 2 THEN 'Binary' {"WHEN n < 5 THEN 'Ordinal' ELSE 'Numeric'" if k == 'num' else "ELSE 'Nominal'"} END AS DTYPE,
       cast(least(n, 5) AS BIGINT) AS N_DISTINCT FROM (SELECT count(DISTINCT {c}) AS n FROM lineitem)""" for c, k in GUESS.items()))
def guess_dtype(spark, sf):
    return p.guess_dtype(lineitem(spark, sf).select(*GUESS))


@query("value_list", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def value_list(spark, sf):
    return p.value_list(table(spark, sf, "part"), "p_type")


PROFILE = {
    "o_orderstatus": {"dtype": "Nominal"},
    "o_orderpriority": {"dtype": "Ordinal", "attr": {"categories": PRIORITIES}},
    "IS_OPEN": {"dtype": "Binary", "attr": {"positives": ["true"]}},
    "o_totalprice": {"dtype": "Numeric"},
}
_ORDERS = "(SELECT *, o_orderstatus = 'O' AS IS_OPEN FROM orders)"


def _dtyped(sql: str, dtype: str) -> str:
    return f'SELECT "COLUMN", STAT, round(VALUE, 4) + 0.0 AS VALUE, \'{dtype}\' AS DTYPE FROM ({sql})'


@query("profile_table", "\nUNION ALL\n".join([
    _dtyped(_counts_sql(_ORDERS, {"o_orderstatus": "o_orderstatus"}), "Nominal"),
    _dtyped(_counts_sql(_ORDERS, {"o_orderpriority": "o_orderpriority"}), "Ordinal"),
    _dtyped(_counts_sql(_ORDERS, {"IS_OPEN": "cast(IS_OPEN AS INTEGER)"}), "Binary"),
    _dtyped(numeric_sql(_ORDERS, "o_totalprice", "o_totalprice", 4), "Numeric")]), digits=4)
def profile_table(spark, sf):
    """Profile of orders, kept under an id, replaced by a second run, and read back."""
    from snapmill.runtime import scratch_path

    orders = table(spark, sf, "orders").withColumn("IS_OPEN", F.col("o_orderstatus") == "O")
    root = scratch_path(spark, "profiles")
    p.save_profile(p.profile_table(orders, {"o_orderstatus": {"dtype": "Nominal"}}), root, "orders")
    p.save_profile(p.profile_table(orders, PROFILE), root, "orders")
    # the moments for preprocessing and the configuration are used by prep_by_profile
    return p.load_profile(spark, root, "orders").where(~F.col("STAT").startswith("FIT_")).drop("CONF")


KEYS = ["l_orderkey", "l_linenumber"]


def keyed(df, cols):
    return df.select(*KEYS, *cols)


@query("prep_binarize", "SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 1 ELSE 0 END AS c_nationkey, "
       "cast(CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS BIGINT) AS FLAG FROM customer")
def prep_binarize(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment") == "BUILDING").alias("FLAG"))
    return prep.prep_binarize(df, ["c_nationkey", "FLAG"])


@query("prep_impute_const", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END, 'Missing') AS SEG, "
       "cast(coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END, -1) AS BIGINT) AS NAT, "
       "cast(c_custkey % 7 = 0 AS BIGINT) AS SEG_MISSING, cast(c_custkey % 5 = 0 AS BIGINT) AS NAT_MISSING FROM customer")
def prep_impute_const(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("SEG"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("NAT"))
    return prep.prep_impute_const(df, {"SEG": prep.TEXT_FILL, "NAT": prep.BINARY_FILL}, indicator=True)


@query("prep_clip", "WITH q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in LINE) + " FROM lineitem) SELECT l_orderkey, "
    "cast(l_linenumber AS BIGINT) AS l_linenumber, " + ", ".join(r(f"least(greatest({c}, {c}_lo), {c}_hi)", c) for c in LINE)
    + " FROM lineitem, q")
def prep_clip(spark, sf):
    df = lineitem(spark, sf)
    return keyed(prep.prep_clip(df, prep.fit_clip(df, LINE)), LINE)


HOLED = "CASE WHEN l_linenumber % 4 <> 0 THEN {c} END"


@query("prep_impute_median", "WITH h AS (SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{HOLED.format(c=c)} AS {c}" for c in LINE) + " FROM lineitem), m AS (SELECT " + ", ".join(
    f"median({c}) AS m_{c}" for c in LINE) + " FROM h) SELECT l_orderkey, cast(l_linenumber AS BIGINT) AS l_linenumber, "
    + ", ".join(r(f"coalesce({c}, m_{c})", c) for c in LINE) + " FROM h, m")
def prep_impute_median(spark, sf):
    df = lineitem(spark, sf).select(*KEYS, *[F.when(F.col("l_linenumber") % 4 != 0, F.col(c)).alias(c) for c in LINE])
    return prep.prep_impute_median(df, prep.fit_median(df, LINE))


@query("prep_standardize", "WITH m AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in LINE)
    + " FROM lineitem) SELECT l_orderkey, cast(l_linenumber AS BIGINT) AS l_linenumber, "
    + ", ".join(r(f"({c} - m_{c}) / s_{c}", c) for c in LINE) + " FROM lineitem, m")
def prep_standardize(spark, sf):
    df = lineitem(spark, sf)
    return keyed(prep.prep_standardize(df, prep.fit_standardize(df, LINE)), LINE)


TOP = """WITH n AS (SELECT p_brand, count(*) AS c FROM part GROUP BY p_brand),
top AS (SELECT p_brand FROM n ORDER BY c DESC, p_brand LIMIT 9),
b AS (SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Other' END AS p_brand FROM part) """


@query("prep_bucket_rare", TOP + "SELECT * FROM b")
def prep_bucket_rare(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand")
    return prep.prep_bucket_rare(df, prep.fit_categories(df, ["p_brand"]))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("prep_onehot", "SELECT c_custkey, " + ", ".join(
    f"cast(c_mktsegment = '{s}' AS DOUBLE) AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM customer")
def prep_onehot(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prep.prep_onehot(df, prep.fit_categories(df, ["c_mktsegment"]))


@query("prep_float", "SELECT l_orderkey, cast(l_linenumber AS DOUBLE) AS l_linenumber, round(l_quantity, 6) + 0.0 AS l_quantity FROM lineitem")
def prep_float(spark, sf):
    return prep.prep_float(lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"])


# the categories that the inputs hold at every scale
TEXTS = {"GENDER": ["F", "M"], "EMAIL_DOMAIN": ["NA", "automobile", "building", "furniture", "household", "machinery"],
         "BLOOD_GRP": ["A+", "A-", "AB+", "AB-", "B+", "B-", "Missing", "O+", "O-"]}
FLAGS = ["SUPER_CITY", "COASTAL_CITY", "MANAGER_FLG", "TECHNICAL_FLG"]
SCALED = ["AGE", "TENURE", "TOTAL_COMP", "NUM_EVENT_7D"]
NUMBERS = ["AGE", "TENURE", "TOTAL_COMP", "BONUS_RATIO", "MAX_NUM_ACCT_7D", "TOTAL_FLOW_7D", "DEB_CRE_FLOW_7D", "AVG_CR_UTIL_7D",
           "MAX_CR_UTIL_7D", "AVG_DR_DEB_3D", "AVG_CR_DEB_3D", "AVG_DR_CRE_3D", "AVG_CR_CRE_3D", "DAYS_SINCE_LAST_EVENT",
           "NUM_EVENT_7D", "RATIO_EVENT_EMAIL", "RATIO_EVENT_CLICK", "RATIO_EVENT_DECLINE"]


def _chains_sql(texts: list[str], flags: list[str], numbers: list[str]) -> str:
    """The chains of the columns' kinds: one-hot, flag with missing mark, clipped, filled and standardised."""
    bounds = ", ".join(f"quantile_cont(cast({c} AS DOUBLE), {q}) AS {c}_{n}" for c in numbers for n, q in (("lo", 0.01), ("mid", 0.5), ("hi", 0.99)))
    filled = ", ".join(f"CASE WHEN {c} IS NULL THEN {c}_mid ELSE least(greatest(cast({c} AS DOUBLE), {c}_lo), {c}_hi) END AS {c}" for c in numbers)
    moments = ", ".join(f"avg({c}) AS {c}_m, coalesce(nullif(stddev_pop({c}), 0), 1) AS {c}_s" for c in numbers)
    out = [f"cast(coalesce({c}, 'Missing') = '{v}' AS INTEGER)::DOUBLE AS \"{c}_{v}\"" for c in texts for v in TEXTS[c]]
    out += [e for c in flags for e in (f"coalesce(cast({c} AS INTEGER), -1)::DOUBLE AS {c}", f"cast({c} IS NULL AS INTEGER)::DOUBLE AS {c}_MISSING")]
    out += [r(f"({c} - {c}_m) / {c}_s", c) for c in numbers]
    return ctes("xy") + f""", q AS (SELECT {bounds} FROM xy),
f AS (SELECT CUST_ID, SNAP_DT, CONV_7D, {", ".join([*texts, *flags])}, {filled} FROM xy, q), m AS (SELECT {moments} FROM f)
SELECT CUST_ID, SNAP_DT, cast(CONV_7D AS BIGINT) AS CONV_7D, {", ".join(out)} FROM f, m"""


@query("prep_by_dtype", _chains_sql(list(TEXTS), FLAGS, NUMBERS))
def prep_by_dtype(spark, sf):
    """Chains chosen by type over the labelled features (keys and target pass through)."""
    xy = xy_written(spark, sf)
    return prep.fit_by_dtype(xy).transform(xy, ["CUST_ID", "SNAP_DT", "CONV_7D"])


@query("prep_by_profile", _chains_sql(["GENDER", "BLOOD_GRP"], ["SUPER_CITY"], SCALED))
def prep_by_profile(spark, sf):
    """The same from a table profile alone."""
    xy = xy_written(spark, sf)
    config = {"GENDER": {"dtype": "Nominal"}, "BLOOD_GRP": {"dtype": "Nominal"}, "SUPER_CITY": {"dtype": "Binary"},
              "AGE": {"dtype": "Numeric"}, "TENURE": {"dtype": "Numeric"}, "TOTAL_COMP": {"dtype": "Numeric"},
              "NUM_EVENT_7D": {"dtype": "Numeric"}}
    return prep.prep_from_profile(p.profile_table(xy, config)).transform(xy, ["CUST_ID", "SNAP_DT", "CONV_7D"])


@query("enc_ordinal", """
SELECT p_partkey, CASE WHEN b IS NULL THEN -2 ELSE coalesce(k, -1) END AS p_brand_CODE
FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_brand END AS b FROM part) x
LEFT JOIN (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) AS k
           FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT LIKE '%1')) d ON d.p_brand = x.b""")
def enc_ordinal(spark, sf):
    """Brands coded by a dictionary that does not know those ending in 1."""
    df = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).alias("p_brand"))
    known = table(spark, sf, "part").where(~F.col("p_brand").endswith("1"))
    return prep.enc_ordinal(df, "p_brand", prep.fit_ordinal(known, "p_brand")).drop("p_brand")


@query("enc_woe", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS cat,
                  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders),
t AS (SELECT sum(y) AS p, sum(1 - y) AS n FROM x),
w AS (SELECT cat, ln(((sum(y) + 1) / cast((SELECT p FROM t) + 2 AS DOUBLE)) / ((sum(1 - y) + 1) / cast((SELECT n FROM t) + 2 AS DOUBLE))) AS woe
      FROM x GROUP BY cat)
SELECT o_orderkey, round(woe, 6) + 0.0 AS cat_WOE FROM x JOIN w ON x.cat IS NOT DISTINCT FROM w.cat""")
def enc_woe(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("cat"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return prep.enc_woe(df, "cat", prep.fit_woe(df, "cat", "y")).select("o_orderkey", "cat_WOE")
