from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import D, SF, dec, plan
from snapmill.operators import coverage as cov
from snapmill.operators import engage as e
from snapmill.operators import rollforward as roll
from snapmill.sources import bindings as b
from snapmill.sources import schemas as s
from snapmill.sources.store import SnapshotTable, columns, preview, src_file, src_query


def snap(spark, d, n, v=1):
    return spark.range(n).select(F.col("id").alias("CUST_ID"), F.lit(v).alias("V"), F.lit(d).alias("SNAP_DT"))


def test_overwrite_is_idempotent_and_touches_one_partition(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    other = D - timedelta(days=1)
    t.overwrite(snap(spark, D, 5).unionByName(snap(spark, other, 3)))
    for _ in range(2):
        t.overwrite(snap(spark, D, 2, 9), D)
    assert t.count(D) == 2 and t.count(other) == 3
    assert {r.SNAP_DT for r in t.list_dates().collect()} == {D, other}
    assert t.succeeded(D) and not t.succeeded(date(2000, 1, 1))


def test_insert_keeps_existing_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.insert(snap(spark, D, 5, 1))
    t.insert(snap(spark, D, 9, 2).unionByName(snap(spark, D + timedelta(days=1), 4, 2)))
    assert {r.SNAP_DT: (r.n, r.v) for r in t.all().groupBy("SNAP_DT").agg(F.count("*").alias("n"), F.max("V").alias("v")).collect()} == {
        D: (5, 1), D + timedelta(days=1): (4, 2)}


def test_reads_prune_partitions(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.overwrite(snap(spark, D, 5).unionByName(snap(spark, D + timedelta(days=1), 3)))
    text = plan(t.read(D).select("CUST_ID"))
    assert "PartitionFilters: [isnotnull(SNAP_DT" in text and "ReadSchema: struct<CUST_ID:bigint>" in text


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    df.coalesce(1).write.option("header", True).csv(str(tmp_path / "x.csv"))
    df.write.parquet(str(tmp_path / "x.parquet"))
    assert src_file(spark, str(tmp_path / "x.csv"), ["k"]).agg(F.sum("k")).first()[0] == 6
    assert src_file(spark, str(tmp_path / "x.parquet"), ["v"], nrows=2).count() == 2
    with pytest.raises(TypeError):
        src_file(spark, "x.json")
    assert src_query(spark, "select count(*) n from src_t", {"src_t": df}).first().n == 3
    assert [r.k for r in preview(df, ["k"], 2).collect()] == [1, 2] and columns(df) == ["k", "v"]


def test_declared_schemas_round_trip_through_files(spark, tmp_path):
    s.write_schema_files(spark, str(tmp_path))
    found = s.read_schema_files(spark, str(tmp_path))
    assert set(found) == set(s.DECLARED)
    for key, schema in found.items():
        assert schema == s.declared_schema(*key)
    assert s.key_columns(found["RAW", "ACCOUNT"]) == ["CUST_ID", "ACCT_ID", "SNAP_DT"]
    assert s.partition_columns(found["TARGET", "TRAINING"]) == ["SNAP_DT", "DATA_ID", "IS_TRAIN"]
    assert len(found["FEATURE", "FEATURES"]) == 27
    with pytest.raises(ValueError):
        s.declared_schema("RAW", "NONE")


def test_schema_documents_keep_their_descriptions(spark, tmp_path):
    document = {"K": {"dtype": "Int64", "args": {"nullable": False}, "descr": "the key", "primary_key": True},
                "V": {"dtype": "Decimal", "args": {"precision": 12, "scale": 2, "nullable": True}, "descr": "a value"}}
    schema = s.from_document(document)
    assert schema["K"].metadata == {"primary_key": True, "partition_key": False, "descr": "the key"}
    assert schema["V"].dataType.simpleString() == "decimal(12,2)" and schema["V"].nullable
    s.write_schema_files(spark, str(tmp_path), {("X", "T"): schema})
    assert s.read_schema_files(spark, str(tmp_path)) == {("X", "T"): schema}
    with pytest.raises(ValueError):
        s.from_document({"A": {"dtype": "Blob"}})


def test_table_init_is_partitioned_and_idempotent(spark, tmp_path):
    schema = s.declared_schema("TARGET", "SCORING")
    for _ in range(2):
        name = s.table_init(spark, "TARGET_T", "SCORING", schema, str(tmp_path / "scoring"))
    parts = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    assert "PARTITIONED BY (SNAP_DT)" in parts
    spark.sql(f"DROP TABLE {name}")


def test_conform_defaults_and_overflow(spark):
    schema = T.StructType([T.StructField("a", T.ByteType(), True), T.StructField("b", T.ByteType(), False),
                           T.StructField("c", T.StringType(), False), T.StructField("d", T.DecimalType(4, 2), False)])
    df = spark.createDataFrame([(300, 300, None, dec("1.239")), (5, None, "x", dec("999.00"))], "a int, b int, c string, d decimal(8,3)")
    out = s.schema_conform(df, schema)
    assert [tuple(r) for r in out.collect()] == [(None, 0, "", dec("1.24")), (5, 0, "x", dec("0.00"))]
    assert [f.dataType for f in out.schema] == [f.dataType for f in schema]


def test_post_check(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, 3)], "k int, v int")
    assert {r.check: r.n_bad for r in s.post_check(df, "t", ["k"], ["k", "v"]).collect()} == {
        "not_empty": 0, "pk_unique": 1, "non_null:k": 0, "non_null:v": 1}


def test_upstream_offsets(spark):
    u = cov.Upstream.past("t", 7, -1)
    assert (u.first, u.last) == (-7, -1)
    u = cov.Upstream.future("t", 7)
    assert (u.first, u.last) == (1, 7)
    wanted = spark.createDataFrame([(D,)], "SNAP_DT date")
    have = spark.createDataFrame([("t", D - timedelta(days=1))], "UPSTREAM string, NEED_DT date")
    out = cov.upstream_coverage(wanted, have, [cov.Upstream.past("t", 2)])
    assert {(r.NEED_DT, r.IS_PRESENT) for r in out.collect()} == {(D, False), (D - timedelta(days=1), True)}
    assert cov.missing_upstreams(out).count() == 1


# --- roll-forward: the expectations on customer and account snapshots -------------------------

def test_customer_roll_forward(spark):
    last = b.customer(spark, SF).limit(10)
    d = D + timedelta(days=1)
    new = spark.range(2).select((F.col("id") + 10_000).alias("CUST_ID"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in last.schema if f.name != "CUST_ID"])
    out = roll.roll_drop_custs(roll.roll_forward(last, d, new), 1)
    assert out.count() == 10 + 2 - 1
    assert {r.SNAP_DT for r in out.collect()} == {d}
    assert [out.schema[c].dataType for c in ("SNAP_DT", "BIRTH_DT", "SINCE_DT")] == [T.DateType()] * 3


def test_account_roll_forward_keeps_current_customers(spark):
    accts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "CUST_ID long, ACCT_ID string").withColumn("SNAP_DT", F.lit(D))
    custs = spark.createDataFrame([(1,), (3,), (3,)], "CUST_ID long").withColumn("SNAP_DT", F.lit(D))
    assert {r.CUST_ID for r in roll.roll_new_custs(custs, accts).collect()} == {3}
    kept = roll.roll_keep_custs(roll.roll_forward(accts, D + timedelta(days=1)), custs)
    assert sorted(r.ACCT_ID for r in kept.collect()) == ["a", "b"]
    assert kept.schema["SNAP_DT"].dataType == T.DateType()


# --- engagement -------------------------------------------------------------------------------

def test_flows_without_credit_side_are_zero(spark):
    cols = "CUST_ID long, ACCT_ID string, SNAP_DT date, ACCT_TYPE_CD string, END_BAL decimal(12,2), DR_AMT decimal(12,2), CR_AMT decimal(12,2), CR_LMT decimal(12,2)"
    one, two = dec("1.00"), dec("2.00")
    rows = [(1, "a", D, "CHQ", one, two, one, None), (2, "b", D, "CRD", one, one, two, dec("10.00")), (3, "c", D, "SAV", two, two, one, None),
            (3, "d", D, "LN", one, one, two, None)]
    two_level = e.eng_acct_two_level(spark.createDataFrame(rows, cols), D)
    ratios = e.eng_acct_ratios(two_level)
    outer, sides = e.eng_full_outer(ratios), e.eng_sides(ratios)
    assert outer.exceptAll(sides.select(outer.columns)).isEmpty() and outer.count() == 3
    out = {r.CUST_ID: r for r in e.eng_flows(sides).collect()}
    assert out[1].TOTAL_FLOW == 0 and out[1].DEB_TO_CRE is None
    assert out[2].TOTAL_FLOW == 1 and out[2].DEB_TO_CRE == 0.0
    assert out[3].TOTAL_FLOW == 2 and out[3].DEB_TO_CRE == 1.0
    assert out[2].CR_UTIL_CRE == 0.1 and out[3].CR_UTIL_CRE is None


def test_eng_fe_checks_uniqueness_and_fills(spark):
    c = spark.createDataFrame([(1, None, 2.0), (2, "x", None)], "CUST_ID long, ORG string, AGE double")
    flows = spark.createDataFrame([(1, 5.0)], "CUST_ID long, TOTAL_FLOW double")
    out = {r.CUST_ID: r for r in e.eng_fe(c, flows).collect()}
    assert (out[1].ORG, out[2].AGE, out[2].TOTAL_FLOW) == ("0", 0.0, 0.0)
    with pytest.raises(ValueError):
        e.eng_fe(c.unionByName(c), flows)


def test_event_features_edges(spark):
    from conftest import ts
    rows = [(1, D, ts("2024-01-09T00:00:00"), "C", "E"), (1, D, ts("2024-01-08T23:59:59"), "C", "E"), (1, D, ts("2024-01-15T00:00:00"), "O", "P"),
            (1, D - timedelta(days=14), ts("2024-01-10T00:00:00"), "D", "P")]
    df = spark.createDataFrame(rows, "CUST_ID long, SNAP_DT date, EVENT_TS timestamp_ntz, EVENT_CD string, EVENT_CHANNEL string")
    r = e.eng_event_pivot(df, D).first()
    assert (r.NUM_EVENT, r.DAYS_SINCE_LAST_EVENT, r.NUM_ENGE_EMAIL, r.NUM_ENGE_PHONE) == (2, 0, 1, 1)
    assert (r.NUM_CLICK, r.NUM_DECLINE, r.NUM_OPEN) == (1, 0, 1)


def test_linear_score_and_noise(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "k long, a double, c string")
    model = {"INTERCEPT": 1.0, "COEF": {"a": -0.5, "c": {"x": 0.25}}}
    out = {r.k: r.PROB for r in e.linear_score(df, model).collect()}
    import math
    assert abs(out[1] - 1 / (1 + math.exp(-0.25))) < 1e-12 and abs(out[2] - 1 / (1 + math.exp(-1.0))) < 1e-12
    with pytest.raises(ValueError):
        e.linear_score(df, model, noise=0.5)
    noisy = {r.k: r.PROB for r in e.linear_score(df, model, noise=0.5, seed=1, key=["k"]).collect()}
    assert all(noisy[k] >= out[k] for k in out)


def test_event_expand_follows_probability(spark):
    df = spark.range(2000).select(F.col("id").alias("CUST_ID"), F.lit(0.25).alias("P"))
    out = e.event_expand(df, "P", D)
    assert abs(out.count() / 14000 - 0.25) < 0.02
    assert out.agg(F.min("EVENT_DT"), F.max("EVENT_DT")).first() == (D + timedelta(days=1), D + timedelta(days=7))


def test_feed_takes_each_file_once(spark, tmp_path):
    from snapmill.streaming.feed import feed_raw

    declared = s.declared_schema("RAW", "PURCHASES")
    src = T.StructType([T.StructField("CUST_ID", T.LongType()), T.StructField("SNAP_DT", T.DateType()),
                        T.StructField("PUR_TS", T.TimestampType()), T.StructField("PUR_NUM", T.IntegerType()),
                        T.StructField("PUR_AMT", T.DoubleType())])
    paths = [str(tmp_path / x) for x in ("landing", "raw", "cp")]
    for day in range(2):
        rows = spark.range(3).select("id", F.lit(D + timedelta(days=day)).alias("d"), F.current_timestamp().alias("t"),
                                     F.lit(2).alias("n"), F.lit(1.5).alias("a")).toDF(*src.names)
        rows.coalesce(1).write.mode("append").parquet(paths[0])
        for _ in range(2):
            feed_raw(spark, paths[0], src, declared, paths[1], paths[2]).awaitTermination()
        out = spark.read.parquet(paths[1])
        assert out.count() == 3 * (day + 1) and out.select("SNAP_DT").distinct().count() == day + 1
    assert out.schema["PUR_AMT"].dataType == T.DecimalType(10, 2)
