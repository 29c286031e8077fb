from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import D, SF, dec, plan, ts
from snapmill.functions import exprs
from snapmill.operators import features as f
from snapmill.operators import ingest
from snapmill.sources import bindings as b

EVENTS = "CUST_ID long, SNAP_DT date, EVENT_TS timestamp_ntz, EVENT_CD string, EVENT_CHANNEL string"
ACCOUNT = ("CUST_ID long, ACCT_ID string, SNAP_DT date, ACCT_TYPE_CD string, END_BAL decimal(12,2), "
           "DR_AMT decimal(12,2), CR_AMT decimal(12,2), CR_LMT decimal(12,2)")


def acct(c, a, d, t, bal="10.00", dr="1.00", cr="2.00", lim=None):
    return (c, a, d, t, dec(bal), dec(dr), dec(cr), None if lim is None else dec(lim))


def test_event_window_edges(spark):
    rows = [(1, D, ts("2024-01-08T00:00:00"), "C", "E"), (1, D, ts("2024-01-15T00:00:00"), "D", "P "),
            (1, D, ts("2024-01-15T00:00:01"), "C", "E"), (1, D, ts("2024-01-07T23:59:59"), "C", "E"),
            (2, D, ts("2024-01-10T12:00:00"), " D", "E")]
    out = {r.CUST_ID: r for r in f.event_window(spark.createDataFrame(rows, EVENTS), D).collect()}
    assert out[1].NUM_EVENT_7D == 2 and out[1].DAYS_SINCE_LAST_EVENT == 0
    assert out[1].RATIO_EVENT_EMAIL == 0.5 and out[1].RATIO_EVENT_CLICK == 0.5 and out[1].RATIO_EVENT_DECLINE == 0.5
    assert out[2].DAYS_SINCE_LAST_EVENT == 5 and out[2].RATIO_EVENT_DECLINE == 1.0


def test_purchase_window_edges(spark):
    rows = [(1, D, ts(t), 3, dec("1.50")) for t in (
        "2024-01-16T00:00:00", "2024-01-23T00:00:00", "2024-01-23T00:00:01", "2024-01-15T23:59:59")]
    df = spark.createDataFrame(rows, "CUST_ID long, SNAP_DT date, PUR_TS timestamp_ntz, PUR_NUM long, PUR_AMT decimal(10,2)")
    r = f.purchase_window(df, D).first()
    assert (r.NUM_PUR_F7D, r.TOTAL_PUR_NUM_F7D, r.TOTAL_PUR_AMT_F7D) == (2, 6, Decimal("3.00"))


def test_windows_accept_session_timestamps(spark):
    rows = [(1, D, ts("2024-01-08T00:00:00"), "C", "E"), (1, D, ts("2024-01-15T00:00:00"), "D", "P")]
    df = spark.createDataFrame(rows, EVENTS).withColumn("EVENT_TS", F.col("EVENT_TS").cast("timestamp"))
    assert f.event_window(df, D).first().NUM_EVENT_7D == 2


def test_acct_base_counts_distinct_rows_but_sums_all(spark):
    rows = [acct(1, "a", D, "CHQ"), acct(1, "a", D, "CHQ"), acct(1, "b", D, "CHQ"), acct(1, "c", D, "CRD", lim=None),
            acct(2, "d", D, "MTG", "5.00", "1.00", "1.00", "100.00")]
    out = {r.CUST_ID: r for r in f.acct_base(spark.createDataFrame(rows, ACCOUNT), D).collect()}
    assert (out[1].NUM_ACCTS_DEB, out[1].NUM_ACCTS_CRE) == (2, 1)
    assert out[1].END_BAL_DEB == Decimal("30.00") and out[1].CR_LMT == 0
    assert (out[2].NUM_ACCTS_DEB, out[2].END_BAL_DEB, out[2].CR_LMT) == (0, 0, Decimal("100.00"))


def test_acct_base_null_type_is_neither_side(spark):
    r = f.acct_base(spark.createDataFrame([acct(1, "a", D, None)], ACCOUNT)).first()
    assert (r.NUM_ACCTS_DEB, r.NUM_ACCTS_CRE, r.END_BAL_DEB, r.END_BAL_CRE) == (0, 0, 0, 0)


def test_acct_window_divides_by_declared_days(spark):
    early = D - timedelta(days=5)
    rows = [acct(1, "a", D, "CRD", "70.00", "3.00", "5.00", "100.00"), acct(1, "a", early, "CRD", "-7.00", "1.00", "1.00", "50.00"),
            acct(2, "b", early, "CHQ")]
    out = f.acct_window(f.acct_base(spark.createDataFrame(rows, ACCOUNT)), D).collect()
    assert [r.CUST_ID for r in out] == [1]
    r = out[0]
    assert abs(r.AVG_CR_UTIL_7D - (63 / 7) / 100) < 1e-12
    assert r.MAX_CR_UTIL_7D == 0.7 and r.TOTAL_FLOW_7D == Decimal("2.00")
    assert abs(r.AVG_DR_CRE_3D - 3 / (70 / 3)) < 1e-12
    assert r.DEB_CRE_FLOW_7D == 0.0 and r.AVG_DR_DEB_3D == 0.0


def test_acct_window_missing_days_count_as_zero_in_maxima(spark):
    r = f.acct_window(f.acct_base(spark.createDataFrame([acct(1, "a", D, "CRD", "-7.00", "1.00", "1.00", "50.00")], ACCOUNT)), D).first()
    assert r.MAX_CR_UTIL_7D == 0.0
    full = [acct(1, "a", D - timedelta(days=k), "CRD", "-7.00", "1.00", "1.00", "50.00") for k in range(7)]
    r = f.acct_window(f.acct_base(spark.createDataFrame(full, ACCOUNT)), D).first()
    assert r.MAX_CR_UTIL_7D == -0.14


def test_window_equals_grid(spark):
    base = f.acct_base(b.account(spark, SF))
    daily = f.acct_daily(base, D)
    assert daily.count() == 7 * base.where(F.col("SNAP_DT") == F.lit(D)).count()
    want = {r.CUST_ID: (r.m, r.s) for r in daily.groupBy("CUST_ID").agg(
        F.max("NUM_ACCTS").alias("m"), F.sum("TOTAL_FLOW").alias("s")).collect()}
    got = {r.CUST_ID: (r.MAX_NUM_ACCT_7D, r.TOTAL_FLOW_7D) for r in f.acct_window(base, D).collect()}
    assert got == want


def test_cust_base_text_and_zero_cases(spark):
    schema = ("CUST_ID long, SNAP_DT date, GENDER string, EMAIL string, BLOOD_GRP string, OFFICE string, TITLE string, "
              "ORG string, BIRTH_DT date, SINCE_DT date, SALARY decimal(10,2), BONUS decimal(10,2)")
    rows = [(1, D, "F", None, None, " New York ", "VP", None, date(1999, 12, 31), None, dec("0.00"), None),
            (2, D, "M", "nobody", "A+", None, "clerk", "DevOps", date(2000, 1, 1), date(2023, 12, 31), dec("844.00"), dec("156.00")),
            (3, D - timedelta(days=1), "M", "a@b.c", "A+", "Seattle", "x", "x", D, D, dec("1.00"), dec("1.00"))]
    out = {r.CUST_ID: r for r in f.cust_base(spark.createDataFrame(rows, schema), D).collect()}
    assert set(out) == {1, 2}
    assert out[1].EMAIL_DOMAIN == "NA" and out[2].EMAIL_DOMAIN is None
    assert (out[1].SUPER_CITY, out[1].COASTAL_CITY, out[1].MANAGER_FLG, out[1].TECHNICAL_FLG) == (True, True, True, False)
    assert (out[2].SUPER_CITY, out[2].TECHNICAL_FLG) == (False, True)
    assert (out[1].AGE, out[2].AGE, out[1].TENURE, out[2].TENURE) == (25, 24, None, 1)
    assert out[1].BONUS_RATIO == 0 and out[2].BONUS_RATIO == Decimal("0.16")


def test_features_keep_null_ratios_and_fill_counts(spark):
    out = f.features(f.cust_base(b.customer(spark, SF), D), f.acct_window(f.acct_base(b.account(spark, SF)), D),
                     f.event_window(b.events(spark, SF), D), D)
    none = out.where("NUM_EVENT_7D = 0")
    assert out.count() == b.customer(spark, SF).count()
    assert none.where("RATIO_EVENT_EMAIL is not null or DAYS_SINCE_LAST_EVENT <> 0").count() == 0


def test_range_equals_single_dates(spark):
    dates = [D, D + timedelta(days=1), D + timedelta(days=4)]
    many = f.features_range(b.customer(spark, SF, dates), b.account(spark, SF), b.events(spark, SF), dates, b.purchases(spark, SF))
    targets = ["NUM_PUR_F7D", "TOTAL_PUR_NUM_F7D", "TOTAL_PUR_AMT_F7D"]
    for d in dates:
        one = f.features(f.cust_base(b.customer(spark, SF, [d]), d), f.acct_window(f.acct_base(b.account(spark, SF)), d),
                         f.event_window(b.events(spark, SF), d), d)
        mine = many.where(F.col("SNAP_DT") == F.lit(d))
        assert one.exceptAll(mine.drop(*targets)).isEmpty() and mine.drop(*targets).exceptAll(one).isEmpty()
        y = f.purchase_window(b.purchases(spark, SF), d)
        got = {r.CUST_ID: (r.NUM_PUR_F7D, r.TOTAL_PUR_NUM_F7D) for r in mine.where("NUM_PUR_F7D > 0").collect()}
        want = {r.CUST_ID: (r.NUM_PUR_F7D, r.TOTAL_PUR_NUM_F7D) for r in y.collect() if r.CUST_ID in
                {c.CUST_ID for c in b.customer(spark, SF).select("CUST_ID").collect()}}
        assert got == want


def test_range_midnight_edges(spark):
    cust = b.customer(spark, SF, [D]).where("CUST_ID = 1")
    ev = spark.createDataFrame([(1, D, ts("2024-01-15T00:00:00"), "C", "E"), (1, D, ts("2024-01-15T10:00:00"), "C", "E"),
                                (1, D, ts("2024-01-08T00:00:00"), "O", "P")], EVENTS)
    pu = spark.createDataFrame([(1, D, ts("2024-01-23T00:00:00"), 2, dec("9.00")), (1, D, ts("2024-01-23T08:00:00"), 2, dec("9.00"))],
                               "CUST_ID long, SNAP_DT date, PUR_TS timestamp_ntz, PUR_NUM long, PUR_AMT decimal(10,2)")
    r = f.features_range(cust, b.account(spark, SF), ev, [D], pu).first()
    assert (r.NUM_EVENT_7D, r.DAYS_SINCE_LAST_EVENT, r.NUM_PUR_F7D) == (2, 0, 1)


def test_extract_restamps_and_prunes(spark, tmp_path):
    rows = [(1, D - timedelta(days=3), ts("2024-01-15T09:00:00"), "C", "E"), (1, D, ts("2024-01-16T09:00:00"), "C", "E")]
    spark.createDataFrame(rows, EVENTS).write.partitionBy("SNAP_DT").parquet(str(tmp_path / "ev"))
    raw = spark.read.parquet(str(tmp_path / "ev"))
    out = ingest.ext_events(raw, D, prune_batches=True)
    assert [(r.CUST_ID, r.SNAP_DT) for r in out.collect()] == [(1, D)]
    text = plan(out)
    assert "PartitionFilters: [isnotnull(SNAP_DT" in text and "PythonUDF" not in text


def test_feature_plan_has_no_python_and_no_single_window(spark):
    text = plan(f.features_range(b.customer(spark, SF, [D]), b.account(spark, SF), b.events(spark, SF), [D], b.purchases(spark, SF)))
    assert "Python" not in text and "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_fixed_length_arrays(spark):
    df = spark.createDataFrame([([1.0, 4.0, 2.0, 9.0],)], "a array<double>")
    r = df.select(exprs.array_max_fixed("a", 3).alias("m"), exprs.array_sum_fixed("a", 3).alias("s"),
                  exprs.array_avg_fixed("a", 3).alias("v")).first()
    assert (r.m, r.s) == (4.0, 7.0) and abs(r.v - 7 / 3) < 1e-12
