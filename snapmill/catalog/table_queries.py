"""Snapshot tables, schemas, sources, registry, coverage."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from snapmill.catalog.inputs import D, account_table, features_at, xy_at
from snapmill.catalog.registry import query
from snapmill.catalog.sql import ctes, r, typed
from snapmill.operators import coverage as cov
from snapmill.operators import ingest
from snapmill.plans import snapshots
from snapmill.runtime import scratch_path
from snapmill.sources import bindings as b
from snapmill.sources import schemas as s
from snapmill.sources.registry import TrainingRegistry
from snapmill.sources.store import SnapshotTable, preview, src_file, src_query

DS = "DATE '2024-01-15'"
TARGET_COLS = ["NUM_PUR_F7D", "TOTAL_PUR_NUM_F7D", "TOTAL_PUR_AMT_F7D"]
ACCT_COLS = ["CUST_ID", "ACCT_ID", "ACCT_TYPE_CD", "END_BAL", "DR_AMT", "CR_AMT", "CR_LMT", "SNAP_DT"]


@query("snap_read", ctes("accts") + f"SELECT {typed(ACCT_COLS)} FROM accts WHERE SNAP_DT = {DS}")
def snap_read(spark, sf):
    return account_table(spark, sf).read(D)


@query("snap_read_many", ctes("accts") + f"SELECT {typed(ACCT_COLS)} FROM accts WHERE SNAP_DT IN ({DS}, {DS} - 1, {DS} - 2)")
def snap_read_many(spark, sf):
    return account_table(spark, sf).read_many([D - timedelta(days=k) for k in range(3)])


@query("snap_list", "SELECT DISTINCT cast(ts AS DATE) AS SNAP_DT FROM events")
def snap_list(spark, sf):
    return account_table(spark, sf).list_dates()


@query("snap_count", "SELECT cast(ts AS DATE) AS SNAP_DT, count(*) AS N_ROWS FROM events GROUP BY 1")
def snap_count(spark, sf):
    return account_table(spark, sf).counts()


def _totals(df):
    return df.groupBy("SNAP_DT").agg(F.count(F.lit(1)).alias("N_ROWS"), F.sum("END_BAL").alias("END_BAL"))


@query("snap_overwrite", ctes("accts") + f"""
SELECT SNAP_DT, count(*) AS N_ROWS, {r('sum(END_BAL)', 'END_BAL', 2)}
FROM accts WHERE SNAP_DT <> {DS} OR ACCT_TYPE_CD = 'CHQ' GROUP BY SNAP_DT""", digits=2)
def snap_overwrite(spark, sf):
    """Write all dates, replace one of them by its CHQ rows, read all back."""
    out = SnapshotTable(spark, scratch_path(spark, "overwrite"))
    rows = b.account(spark, sf)
    out.overwrite(rows)
    out.overwrite(rows.where(F.col("ACCT_TYPE_CD") == "CHQ"), D)
    return _totals(out.all())


@query("snap_insert", ctes("accts") + f"""
SELECT SNAP_DT, count(*) AS N_ROWS, {r(f'sum(CASE WHEN SNAP_DT <= {DS} THEN END_BAL ELSE END_BAL * 2 END)', 'END_BAL', 2)}
FROM accts GROUP BY SNAP_DT""", digits=2)
def snap_insert(spark, sf):
    """Dates up to d exist; an insert of doubled balances for all dates adds only the later ones."""
    out = SnapshotTable(spark, scratch_path(spark, "insert"))
    rows = b.account(spark, sf)
    out.overwrite(rows.where(F.col("SNAP_DT") <= F.lit(D)))
    out.insert(rows.withColumn("END_BAL", (F.col("END_BAL") * 2).cast("decimal(12,2)")))
    return _totals(out.all())


@query("table_init", ctes("evts") + "SELECT SNAP_DT, count(*) AS N_ROWS, count(DISTINCT CUST_ID) AS N_CUSTS FROM evts GROUP BY SNAP_DT")
def table_init(spark, sf):
    """Create RAW.EVENTS from its declared schema, insert conformed rows, read it by partition."""
    location = scratch_path(spark, "raw_events")
    schema = s.declared_schema("RAW", "EVENTS")
    name = s.table_init(spark, "RAW", f"EVENTS_{location[-8:]}", schema, location)
    rows = s.schema_conform(ingest.raw_events(b.events(spark, sf)), schema)
    # partition columns come last in the table
    ordered = [c for c in schema.names if c not in s.partition_columns(schema)] + s.partition_columns(schema)
    rows.select(*ordered).hint("rebalance", F.col("SNAP_DT")).write.insertInto(name, overwrite=False)
    return spark.table(name).groupBy("SNAP_DT").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.count_distinct("CUST_ID").alias("N_CUSTS"))


CONFORM_ZERO = ["MAX_NUM_ACCT_7D", "TOTAL_FLOW_7D", "DEB_CRE_FLOW_7D", "AVG_CR_UTIL_7D", "MAX_CR_UTIL_7D",
                "AVG_DR_DEB_3D", "AVG_CR_DEB_3D", "AVG_DR_CRE_3D", "AVG_CR_CRE_3D"]


def _conform_sql() -> str:
    cols = []
    for f in s.declared_schema("FEATURE", "FEATURES"):
        c, t = f.name, f.dataType.simpleString()
        sql_type = {"float": "FLOAT", "bigint": "BIGINT", "string": "VARCHAR"}.get(t, t.upper())
        e = f"try_cast({c} AS {sql_type})"
        if not f.nullable and t not in ("date", "boolean"):
            e = f"coalesce({e}, {chr(39) * 2 if t == 'string' else '0'})"
        if t in ("tinyint", "smallint", "bigint"):
            e = f"cast({e} AS BIGINT) AS {c}"
        elif t == "float" or t.startswith("decimal"):
            e = r(e, c, 4)
        else:
            e = f"{e} AS {c}"
        cols.append(e)
    return ctes("features") + "SELECT " + ", ".join(cols) + " FROM features"


@query("schema_conform", _conform_sql(), digits=4)
def schema_conform(spark, sf):
    return s.schema_conform(features_at(spark, sf), s.declared_schema("FEATURE", "FEATURES"))


def _warehouse(spark, sf):
    """Source tables of the run, loaded by snapshot date."""
    house = snapshots.Warehouse(spark, scratch_path(spark, "warehouse"))
    house.load("EXTRACT.CUSTOMER", b.customer(spark, sf, [D]))
    house.load("EXTRACT.ACCOUNT", b.account(spark, sf))
    house.load("EXTRACT.EVENTS", b.events(spark, sf))
    house.load("EXTRACT.PURCHASES", b.purchases(spark, sf))
    return house


@query("run_snapshot", _conform_sql(), digits=4)
def run_snapshot(spark, sf):
    """Features made by the daily run from partitioned sources, read back."""
    house = _warehouse(spark, sf)
    house.run(snapshots.FEATURES, D, complete=False)
    return house.table("FEATURE.FEATURES").read(D)


@query("run_target", ctes("purchase_window") + f"SELECT {typed(['CUST_ID', 'SNAP_DT', *TARGET_COLS])} FROM purchase_window")
def run_target(spark, sf):
    house = _warehouse(spark, sf)
    house.run(snapshots.PURCHASE_WINDOW, D, complete=False)
    return house.table("TARGET.PURCHASE_WINDOW").read(D)


@query("post_check", ctes("accts") + """
SELECT 'RAW.ACCOUNT' AS "table", 'not_empty' AS "check", cast(count(*) = 0 AS BIGINT) AS n_bad FROM accts
UNION ALL SELECT 'RAW.ACCOUNT', 'pk_unique', count(*) FROM (
    SELECT 1 FROM accts GROUP BY CUST_ID, ACCT_ID, SNAP_DT HAVING count(*) > 1)
UNION ALL SELECT 'RAW.ACCOUNT', 'non_null:CUST_ID', count(*) FILTER (CUST_ID IS NULL) FROM accts
UNION ALL SELECT 'RAW.ACCOUNT', 'non_null:END_BAL', count(*) FILTER (END_BAL IS NULL) FROM accts
UNION ALL SELECT 'RAW.ACCOUNT', 'non_null:CR_LMT', count(*) FILTER (CR_LMT IS NULL) FROM accts""")
def post_check(spark, sf):
    return s.post_check(b.account(spark, sf), "RAW.ACCOUNT", ["CUST_ID", "ACCT_ID", "SNAP_DT"],
                        ["CUST_ID", "END_BAL", "CR_LMT"])


@query("src_file", "SELECT o_orderkey, o_custkey, round(o_totalprice, 2) + 0.0 AS o_totalprice FROM orders", digits=2)
def q_src_file(spark, sf):
    return src_file(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


@query("src_query", """
SELECT event_type, cast(ts AS DATE) AS day, count(*) AS n, round(sum(value), 2) + 0.0 AS total
FROM events GROUP BY event_type, cast(ts AS DATE)""", digits=2)
def q_src_query(spark, sf):
    return src_query(spark, """
        SELECT event_type, cast(ts AS DATE) AS day, count(*) AS n, sum(value) AS total
        FROM src_events GROUP BY event_type, cast(ts AS DATE)""", {"src_events": b.table(spark, sf, "events")})


@query("preview", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10")
def q_preview(spark, sf):
    return preview(b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"])


def _registered(spark, sf, *ids):
    registry = TrainingRegistry(spark, scratch_path(spark, "training"))
    xy = xy_at(spark, sf)
    is_train = F.col("CUST_ID") % 5 != 0
    for data_id in ids:
        # every id is put twice: the second replaces the first
        registry.put(data_id, xy.where(F.col("CONV_7D") == 1), xy.where(F.col("CONV_7D") == 1))
        registry.put(data_id, xy.where(is_train), xy.where(~is_train))
    return registry


REG_COUNTS = """
SELECT '{0}' AS DATA_ID, CUST_ID % 5 <> 0 AS IS_TRAIN, cast(CONV_7D AS BIGINT) AS CONV_7D, count(*) AS N_ROWS
FROM xy GROUP BY 2, 3"""


@query("reg_put", ctes("xy") + REG_COUNTS.format("run-1"))
def reg_put(spark, sf):
    return _registered(spark, sf, "run-1").all().groupBy("DATA_ID", "IS_TRAIN", "CONV_7D").agg(
        F.count(F.lit(1)).alias("N_ROWS"))


FETCHED = ["CUST_ID", "SNAP_DT", "GENDER", "TOTAL_COMP", "NUM_EVENT_7D", "CONV_7D"]


@query("reg_fetch", ctes("xy") + f"SELECT {typed(FETCHED)} FROM xy WHERE CUST_ID % 5 <> 0")
def reg_fetch(spark, sf):
    train, _ = _registered(spark, sf, "run-1").fetch("run-1")
    return train.select(*FETCHED)


@query("reg_list", "SELECT 'run-1' AS DATA_ID UNION ALL SELECT 'run-2'")
def reg_list(spark, sf):
    return _registered(spark, sf, "run-1", "run-2").ids()


@query("reg_remove", ctes("xy") + REG_COUNTS.format("run-2"))
def reg_remove(spark, sf):
    registry = _registered(spark, sf, "run-1", "run-2")
    registry.remove("run-1")
    return registry.all().groupBy("DATA_ID", "IS_TRAIN", "CONV_7D").agg(F.count(F.lit(1)).alias("N_ROWS"))


# the features of every event date, of whose inputs the account snapshots of some weekdays are withheld
COVERAGE = """
WITH dates AS (SELECT DISTINCT cast(ts AS DATE) AS SNAP_DT FROM events),
need AS (
  SELECT SNAP_DT, 'FEATURE.ACCT_BASE' AS UPSTREAM, unnest(generate_series(SNAP_DT - 6, SNAP_DT, INTERVAL 1 DAY)) AS dt FROM dates
  UNION ALL
  SELECT SNAP_DT, 'EXTRACT.PURCHASES', unnest(generate_series(SNAP_DT + 1, SNAP_DT + 7, INTERVAL 1 DAY)) FROM dates
  UNION ALL
  SELECT SNAP_DT, 'EXTRACT.CUSTOMER', SNAP_DT FROM dates),
have AS (
  SELECT DISTINCT 'FEATURE.ACCT_BASE' AS UPSTREAM, cast(ts AS DATE) AS dt FROM events WHERE dayofmonth(ts) % 7 <> 0
  UNION ALL
  SELECT DISTINCT 'EXTRACT.PURCHASES', cast(ts AS DATE) FROM events WHERE event_type = 'purchase')
SELECT n.SNAP_DT, n.UPSTREAM, cast(n.dt AS DATE) AS NEED_DT, h.dt IS NOT NULL AS IS_PRESENT
FROM need n LEFT JOIN have h ON h.UPSTREAM = n.UPSTREAM AND h.dt = cast(n.dt AS DATE)"""


@query("upstream_coverage", COVERAGE)
def upstream_coverage(spark, sf):
    day = F.col("ts").cast("date")
    events = b.table(spark, sf, "events")
    wanted = events.select(day.alias("SNAP_DT")).distinct()
    have = (events.where(F.dayofmonth("ts") % 7 != 0).select(F.lit("FEATURE.ACCT_BASE").alias("UPSTREAM"), day.alias("NEED_DT"))
            .unionByName(events.where("event_type = 'purchase'")
                         .select(F.lit("EXTRACT.PURCHASES").alias("UPSTREAM"), day.alias("NEED_DT"))).distinct())
    upstreams = [cov.Upstream.past("FEATURE.ACCT_BASE", 7), cov.Upstream.future("EXTRACT.PURCHASES", 7),
                 cov.Upstream.current("EXTRACT.CUSTOMER")]
    return cov.upstream_coverage(wanted, have, upstreams)


RAW_CUST = ["NAME", "GENDER", "BIRTH_DT", "PHONE", "EMAIL", "BLOOD_GRP", "JOB", "OFFICE", "ADDRESS", "ORG", "TITLE", "SINCE_DT"]
RAW_CUST_SQL = f"SELECT CUST_ID, SNAP_DT, {', '.join(RAW_CUST)}, {r('SALARY', 'SALARY', 2)}, {r('BONUS', 'BONUS', 2)} FROM custs"
MONEY_COLS = ", ".join(r(c, c, 2) for c in ("END_BAL", "DR_AMT", "CR_AMT", "CR_LMT"))
PUR_COLS = f"cast(PUR_NUM AS BIGINT) AS PUR_NUM, {r('PUR_AMT', 'PUR_AMT', 2)}"


@query("raw_customer", ctes("custs") + RAW_CUST_SQL, digits=2)
def raw_customer(spark, sf):
    return ingest.raw_customer(b.customer(spark, sf))


@query("raw_account", ctes("accts") + f"SELECT CUST_ID, ACCT_ID, SNAP_DT, ACCT_TYPE_CD, {MONEY_COLS} FROM accts", digits=2)
def raw_account(spark, sf):
    return ingest.raw_account(b.account(spark, sf))


@query("raw_events", ctes("evts") + "SELECT * FROM evts")
def raw_events(spark, sf):
    return ingest.raw_events(b.events(spark, sf))


@query("raw_purchases", ctes("purs") + f"SELECT CUST_ID, SNAP_DT, PUR_TS, {PUR_COLS} FROM purs", digits=2)
def raw_purchases(spark, sf):
    return ingest.raw_purchases(b.purchases(spark, sf))


@query("ext_customer", ctes("custs") + RAW_CUST_SQL + f" WHERE SNAP_DT = {DS}", digits=2)
def ext_customer(spark, sf):
    return ingest.ext_customer(ingest.raw_customer(b.customer(spark, sf)), D)


@query("ext_account", ctes("accts") + f"SELECT CUST_ID, ACCT_ID, SNAP_DT, ACCT_TYPE_CD, {MONEY_COLS} FROM accts WHERE SNAP_DT = {DS}", digits=2)
def ext_account(spark, sf):
    return ingest.ext_account(b.account(spark, sf), D)


@query("ext_events", ctes("evts") + f"""
SELECT CUST_ID, {DS} AS SNAP_DT, EVENT_TS, EVENT_CHANNEL, EVENT_CD FROM evts WHERE cast(EVENT_TS AS DATE) = {DS}""")
def ext_events(spark, sf):
    return ingest.ext_events(b.events(spark, sf), D)


@query("ext_purchases", ctes("purs") + f"""
SELECT CUST_ID, {DS} AS SNAP_DT, PUR_TS, {PUR_COLS} FROM purs WHERE cast(PUR_TS AS DATE) = {DS}""", digits=2)
def ext_purchases(spark, sf):
    return ingest.ext_purchases(b.purchases(spark, sf), D)
