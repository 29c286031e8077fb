"""The daily run over a small warehouse."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import D, SF, plan
from snapmill.plans import snapshots as sn
from snapmill.sources import bindings as b


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    h = sn.Warehouse(spark, str(tmp_path_factory.mktemp("house")))
    h.load("EXTRACT.CUSTOMER", b.customer(spark, SF, [D]))
    h.load("EXTRACT.ACCOUNT", b.account(spark, SF))
    h.load("EXTRACT.EVENTS", b.events(spark, SF))
    h.load("EXTRACT.PURCHASES", b.purchases(spark, SF))
    return h


def test_a_second_run_changes_nothing(house):
    done = house.run_range(sn.STEPS, [D], complete=False)
    assert set(done.values()) == {"written"}
    before = house.table("FEATURE.FEATURES").read(D).collect()
    assert set(house.run_range(sn.STEPS, [D], complete=False).values()) == {"present"}
    assert house.table("FEATURE.FEATURES").read(D).collect() == before
    assert len(before) == len({r.CUST_ID for r in before}) > 0


def test_every_source_is_pruned_by_date(house):
    for step in sn.STEPS:
        for name, df in house.inputs(step, D).items():
            assert "PartitionFilters: [isnotnull(SNAP_DT" in plan(df), name


def test_missing_upstreams_raise(house):
    with pytest.raises(sn.MissingUpstream, match="EXTRACT.CUSTOMER 2024-01-20"):
        house.run(sn.FEATURES, D + timedelta(days=5), complete=False)
    with pytest.raises(sn.MissingUpstream):
        house.run(sn.FEATURES, D - timedelta(days=4000))


def test_a_snapshot_that_breaks_a_rule_is_removed(spark, house):
    twice = sn.Step("TARGET", "PURCHASE_WINDOW", sn.PURCHASE_WINDOW.upstreams,
                    lambda inputs, d: sn._purchases(inputs, d).limit(0))
    with pytest.raises(sn.CheckFailed, match="not_empty"):
        house.run(twice, D - timedelta(days=1), complete=False)
    assert not house.table("TARGET.PURCHASE_WINDOW").succeeded(D - timedelta(days=1))


def test_a_failed_check_leaves_the_earlier_snapshot(spark, house, monkeypatch):
    day = D - timedelta(days=2)
    stored = house.table("TARGET.PURCHASE_WINDOW")
    step = sn.Step("TARGET", "PURCHASE_WINDOW", sn.PURCHASE_WINDOW.upstreams, sn._purchases)
    house.run(step, day, complete=False)
    before = stored.read(day).count()
    assert before > 0
    monkeypatch.setattr(type(stored), "succeeded", lambda self, d: False)
    broken = sn.Step("TARGET", "PURCHASE_WINDOW", sn.PURCHASE_WINDOW.upstreams, lambda inputs, d: sn._purchases(inputs, d).limit(0))
    with pytest.raises(sn.CheckFailed):
        house.run(broken, day, complete=False)
    assert stored.read(day).count() == before
    # another run of the date finds it published and gives way
    assert house.run(step, day, complete=False) == "present" and stored.read(day).count() == before


def snap(spark, n, v):
    return spark.range(n).select(F.col("id").alias("CUST_ID"), F.lit(v).alias("V"), F.lit(D).alias("SNAP_DT"))


def test_only_published_versions_are_read(spark, tmp_path):
    table = sn.SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(snap(spark, 3, 1), D)
    # a write that died before its commit
    abandoned = table.stage(snap(spark, 9, 2), D)
    assert table.count(D) == 3 and table.staged(abandoned).count() == 9
    table.overwrite(snap(spark, 4, 3), D)
    assert [tuple(r) for r in table.all().groupBy("V").count().collect()] == [(3, 4)]
    # a reader planned on the older version still finds its files until vacuum
    assert table.vacuum() == 2 and table.count(D) == 4
    assert table.all().columns == ["CUST_ID", "V", "SNAP_DT"]


def test_two_inserts_of_a_date_cannot_both_win(spark, tmp_path):
    table = sn.SnapshotTable(spark, str(tmp_path / "t"))
    one, two = table.stage(snap(spark, 3, 1), D), table.stage(snap(spark, 5, 2), D)
    assert table.publish(one, replace=False) == [f"SNAP_DT={D}"] and table.publish(two, replace=False) == []
    assert table.count(D) == 3
    # both saw the same state: the marker's number decides
    n, _ = table.log.state(f"SNAP_DT={D}")
    assert table.log.commit(f"SNAP_DT={D}", two, n) and not table.log.commit(f"SNAP_DT={D}", one, n)
    assert table.count(D) == 5
    # a marker whose writer died half way does not count
    (tmp_path / "t" / "_commits" / f"SNAP_DT={D}" / str(n + 2)).write_text("v1")
    assert table.count(D) == 5
    table.overwrite(snap(spark, 2, 4), D)
    assert table.count(D) == 2


def test_a_plain_folder_is_read_as_it_stands(spark, tmp_path):
    snap(spark, 3, 1).write.partitionBy("SNAP_DT").parquet(str(tmp_path / "t"))
    table = sn.SnapshotTable(spark, str(tmp_path / "t"))
    assert table.succeeded(D) and table.count(D) == 3
    with pytest.raises(ValueError, match="without commit markers"):
        table.overwrite(snap(spark, 3, 1), D)


def test_linear_models_score_after_snapshot_writes(spark, tmp_path):
    """A write must leave nothing in the session that a fitted model would carry into its tasks."""
    from snapmill.operators import model as m
    from snapmill.plans import training
    from snapmill.sources.registry import TrainingRegistry

    table = sn.SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(snap(spark, 3, 1), D)
    TrainingRegistry(spark, str(tmp_path / "reg")).put("a", spark.range(3), spark.range(2))
    rows = spark.range(200).select(F.col("id").alias("CUST_ID"), F.lit(D).alias("SNAP_DT"), F.randn(1).alias("x"))
    rows = rows.withColumn("CONV_7D", (F.col("x") + F.randn(2) > 0).cast("int"))
    for params, tune in ((m.LinearParams(loss="log", max_iter=5), None), (m.LinearParams(max_iter=5), None),
                         (m.LinearParams(max_iter=5), m.TuneParams(n_trials=1))):
        model = training.train(rows, params, tune, ["x"])
        assert model.score(rows, ["CUST_ID"]).count() == 200 and model.score(rows, ["CUST_ID"]).agg(F.min("PROB_CLS1")).first()[0] is not None


def test_roll_forward_through_the_warehouse(spark, house):
    day = D + timedelta(days=1)
    rolled = house.table("EXTRACT.CUSTOMER").read(D).withColumn("SNAP_DT", F.lit(day))
    house.load("EXTRACT.CUSTOMER", rolled)
    stored = house.table("EXTRACT.CUSTOMER")
    assert stored.read(day).count() == stored.read(D).count()
    assert dict(stored.read(day).dtypes)["SNAP_DT"] == "date"
