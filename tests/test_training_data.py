from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import D, dec
from snapmill.operators import labels, sampling
from snapmill.plans.training import make_training_set
from snapmill.sources.registry import TrainingRegistry

TARGET = "CUST_ID long, SNAP_DT date, NUM_PUR_F7D long, TOTAL_PUR_NUM_F7D long, TOTAL_PUR_AMT_F7D decimal(10,2)"


@pytest.fixture(scope="module")
def panel(spark):
    return (spark.range(4000).select((F.col("id") % 400).alias("CUST_ID"),
                                     F.date_add(F.lit(D), (F.col("id") / 400).cast("int")).alias("SNAP_DT"),
                                     (F.col("id") % 10 == 0).cast("int").alias("CONV_7D")))


def test_label_rule_is_strict(spark):
    rows = [(1, D, 1, 9, dec("99.00")), (2, D, 2, 5, dec("50.00")), (3, D, 2, 6, dec("0.00")), (4, D, 2, 1, dec("50.01"))]
    assert sorted(r.CUST_ID for r in labels.label_rule(spark.createDataFrame(rows, TARGET)).collect()) == [3, 4]


def test_joined_xy_marks_missing_as_zero(spark):
    x = spark.createDataFrame([(1, D), (2, D), (1, D + timedelta(days=1)), (1, D + timedelta(days=9))], "CUST_ID long, SNAP_DT date")
    y = spark.createDataFrame([(1, D, 3, 9, dec("1.00"))], TARGET)
    out = labels.joined_xy(x, y, [D, D + timedelta(days=1)]).collect()
    assert sorted((r.CUST_ID, r.SNAP_DT, r.CONV_7D) for r in out) == [(1, D, 1), (1, D + timedelta(days=1), 0), (2, D, 0)]


def test_stratified_sample_is_exact_and_matches_full_ranking(panel):
    got = sampling.sample_stratify(panel, 0.25, "CONV_7D", seed=3)
    assert {r.CONV_7D: r["count"] for r in got.groupBy("CONV_7D").count().collect()} == {0: 900, 1: 100}
    key = sampling.row_key(["CUST_ID", "SNAP_DT"])
    ranked = sorted((r.CONV_7D, r.h, r.k) for r in panel.select(
        "CONV_7D", sampling.hash32(key, 3).alias("h"), key.alias("k")).collect())
    want = {k for s, n in ((0, 900), (1, 100)) for _, _, k in [x for x in ranked if x[0] == s][:n]}
    assert {r.k for r in got.select(key.alias("k")).collect()} == want


def test_stratified_sample_with_null_and_tiny_strata(spark):
    df = spark.range(21).select(F.col("id").alias("CUST_ID"), F.lit(D).alias("SNAP_DT"),
                                F.when(F.col("id") < 20, F.lit(None).cast("string")).otherwise("x").alias("S"))
    out = sampling.mark_stratify(df, 0.25, "S").where("IS_PICKED").groupBy("S").count().collect()
    assert {r.S: r["count"] for r in out} == {None: 5}


@pytest.mark.parametrize("method", ["simple", "stratify", "group", "timeseries"])
def test_splits_cover_and_are_disjoint(panel, method):
    marked = {"simple": lambda: sampling.mark_simple(panel, 0.8, 1),
              "stratify": lambda: sampling.mark_stratify(panel, 0.8, "CONV_7D", 1),
              "group": lambda: sampling.mark_group(panel, 0.8, 1),
              "timeseries": lambda: sampling.mark_timeseries(panel, 0.8)}[method]()
    train, test = sampling.split(marked)
    assert train.count() + test.count() == panel.count()
    assert train.intersect(test).isEmpty()
    assert 0.7 < train.count() / panel.count() < 0.9
    if method == "group":
        assert train.select("CUST_ID").intersect(test.select("CUST_ID")).isEmpty()
    if method == "timeseries":
        assert train.agg(F.max("SNAP_DT")).first()[0] < test.agg(F.min("SNAP_DT")).first()[0]


def test_make_training_set_rejects_unknown_methods(panel):
    with pytest.raises(ValueError):
        make_training_set(panel, panel, [D], sample_method="other")
    with pytest.raises(ValueError):
        make_training_set(panel, panel, [D], split_method="other")


def test_registry_replaces_fetches_and_removes(spark, panel, tmp_path):
    reg = TrainingRegistry(spark, str(tmp_path / "reg"))
    assert reg.ids().collect() == []
    with pytest.raises(ValueError):
        reg.fetch("2024")
    reg.put("2024", panel.limit(10), panel.limit(5))
    reg.put("b", panel.limit(3), panel.limit(2))
    reg.put("2024", panel.limit(7), panel.limit(4))
    train, test = reg.fetch("2024")
    assert (train.count(), test.count()) == (7, 4) and set(train.columns) == set(panel.columns)
    assert sorted(r.DATA_ID for r in reg.ids().collect()) == ["2024", "b"]
    reg.remove("2024")
    assert [r.DATA_ID for r in reg.ids().collect()] == ["b"]


def test_registry_shows_the_visible_rows_of_all_ids(spark, panel, tmp_path):
    reg = TrainingRegistry(spark, str(tmp_path / "reg"))
    assert reg.all().collect() == []
    # ids that look like numbers, or hold characters that folder names escape, stay text
    for data_id in ("007", "a/b=c"):
        reg.put(data_id, panel.limit(9), panel.limit(9))
        reg.put(data_id, panel.limit(7), panel.limit(4))

    def counts():
        return {(r.DATA_ID, r.IS_TRAIN): r["count"] for r in reg.all().groupBy("DATA_ID", "IS_TRAIN").count().collect()}

    assert counts() == {("007", True): 7, ("007", False): 4, ("a/b=c", True): 7, ("a/b=c", False): 4}
    reg.remove("007")
    assert counts() == {("a/b=c", True): 7, ("a/b=c", False): 4}
    reg.remove("a/b=c")
    assert reg.all().collect() == []


@pytest.mark.parametrize("name", ["reg_put", "reg_remove"])
def test_registry_queries_agree_with_their_sql(spark, name):
    import duckdb

    from conftest import SF
    from snapmill.catalog import ORACLES, QUERIES

    db = duckdb.connect()
    for table in ("customer", "supplier", "orders", "lineitem", "events", "part", "nation", "region"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = db.execute(ORACLES[name]).df()
    assert sorted(map(tuple, got.collect())) == sorted(want[got.columns].itertuples(index=False, name=None))
