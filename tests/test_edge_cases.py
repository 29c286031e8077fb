"""Results on odd input: empty snapshots and sides, ids of any text, missing labels, perfect columns."""

import math

from pyspark.sql import functions as F

from conftest import D, ts
from snapmill.operators import calendar as cal
from snapmill.operators import prep, profile, sampling
from snapmill.operators import select as fs
from snapmill.sources.registry import TrainingRegistry
from snapmill.sources.store import SnapshotTable


def test_registry_replaces_an_empty_side(spark, tmp_path):
    registry = TrainingRegistry(spark, str(tmp_path / "reg"))
    rows = spark.range(4)
    registry.put("a", rows, rows)
    registry.put("a", rows, rows.limit(0))
    train, test = registry.fetch("a")
    assert train.count() == 4 and test.count() == 0
    registry.put("a", rows.limit(0), rows.limit(0))
    assert not registry.has("a")


def test_registry_ids_are_any_text(spark, tmp_path):
    registry = TrainingRegistry(spark, str(tmp_path / "reg"))
    names = ["001", "run#1", "a=b", "run:1", "x y%"]
    for n in names:
        registry.put(n, spark.range(2), spark.range(1))
    assert {r.DATA_ID for r in registry.ids().collect()} == set(names)
    assert registry.fetch("001")[0].count() == 2
    for n in names[1:]:
        registry.remove(n)
    assert [r.DATA_ID for r in registry.ids().collect()] == ["001"]


def test_overwriting_with_nothing_removes_the_snapshot(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = spark.range(3).withColumn("SNAP_DT", F.lit(D))
    table.overwrite(rows, D)
    table.overwrite(rows.limit(0), D)
    assert not table.succeeded(D)


def test_a_perfect_column_is_kept(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (0, 1.0, 5.0), (1, 2.0, 5.0), (1, 2.0, 5.0)], "y int, perfect double, flat double")
    f = {r.COLUMN: r.F for r in fs.anova_f(df, ["perfect", "flat"], "y").collect()}
    assert math.isinf(f["perfect"]) and f["flat"] is None
    assert [r[0] for r in fs.fsel_anova(df, ["perfect", "flat"], "y")] == ["perfect"]


def test_one_class_has_no_f(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "y int, x double")
    assert fs.anova_f(df, ["x"], "y").first().F is None
    assert fs.fsel_anova(df, ["x"], "y") == []


def test_rows_without_label_do_not_count(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("b", None), ("c", None)], "c string, y int")
    full = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "c string, y int")
    assert fs.mutual_info(df, ["c"], "y").first().MI == fs.mutual_info(full, ["c"], "y").first().MI
    woe = {r.CATEGORY: r.WOE for r in prep.fit_woe(df, "c", "y").collect()}
    assert woe == {r.CATEGORY: r.WOE for r in prep.fit_woe(full, "c", "y").collect()}


def test_number_coded_flags_are_positive(spark):
    df = spark.createDataFrame([(1.0, 1, "1", True), (0.0, 0, "Y", False), (None, None, None, None)], "d double, i int, s string, b boolean")
    df = df.withColumn("m", F.col("d").cast("decimal(9,2)"))
    rows = prep.prep_binarize(df, df.columns).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1, 1, 1), (0, 0, 1, 0, 0), (None,) * 5]
    one = {(r.COLUMN, r.STAT): r.VALUE for r in profile.eda_binary(df, ["d"]).collect()}
    assert one["d", "COUNT:1"] == 1


def test_rows_without_entity_stay_in_a_group_split(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "CUST_ID long, x int").withColumn("SNAP_DT", F.lit(D))
    train, test = sampling.split(sampling.mark_group(df, 0.5))
    assert train.count() + test.count() == 3
    assert {r.x for r in train.collect()} >= {1, 2} or {r.x for r in test.collect()} >= {1, 2}


def test_gaps_begin_where_all_intervals_ended(spark):
    rows = [("a", ts("2024-01-01"), ts("2024-01-20")), ("b", ts("2024-01-03"), ts("2024-01-05")), ("c", ts("2024-02-01"), ts("2024-02-03"))]
    filled = cal.calendar_gapfill(spark.createDataFrame(rows, "MODEL_ID string, START_TS timestamp_ntz, END_TS timestamp_ntz"), "prod")
    assert [(r.START_TS, r.END_TS) for r in filled.where("MODEL_ID = 'prod'").collect()] == [(ts("2024-01-20"), ts("2024-02-01"))]


def test_both_ways_of_picking_a_model_agree(spark, monkeypatch):
    rows = [("a", ts("2024-01-01"), ts("2024-01-03T12:00:00")), ("b", ts("2024-01-05"), ts("9999-12-31"))]
    calendar = spark.createDataFrame(rows, "MODEL_ID string, START_TS timestamp_ntz, END_TS timestamp_ntz")
    dates = spark.range(9).select(F.date_add(F.lit("2023-12-30").cast("date"), F.col("id").cast("int")).alias("d"))
    by_range = {r.d: r.MODEL_ID for r in cal.model_pick(dates, calendar, "d", "prod").collect()}
    monkeypatch.setattr(cal, "RANGE_ROWS", 0)
    assert {r.d: r.MODEL_ID for r in cal.model_pick(dates, calendar, "d", "prod").collect()} == by_range
    assert set(by_range.values()) == {"a", "b", "prod"}


def test_shared_inputs_follow_their_folder(spark, tmp_path):
    from snapmill.catalog.inputs import once

    folder = str(tmp_path / "in")
    made = []
    for _ in range(2):
        once(spark, ("x", str(tmp_path)), lambda: made.append(1))
    assert len(made) == 1
    spark.range(3).write.parquet(folder)
    once(spark, ("x", str(tmp_path)), lambda: made.append(1))
    assert len(made) == 2
