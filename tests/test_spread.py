import re
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import SF, D, plan
from snapmill.catalog.inputs import xy_written
from snapmill.operators import features as f
from snapmill.operators import select as fs
from snapmill.operators.model import LinearParams
from snapmill.plans import training
from snapmill.sources import bindings as b


def tasks(df) -> int:
    return df.rdd.getNumPartitions()


def test_inputs_of_fits_have_a_task_per_core(spark):
    cores = spark.sparkContext.defaultParallelism
    xy = xy_written(spark, SF)
    assert tasks(xy) >= cores
    ready, cols = fs.wrapper_inputs(xy, "CONV_7D")
    assert tasks(ready) >= cores
    assert ready.count() == xy.count() and len(cols) == 25


def test_training_rows_have_a_task_per_core(spark, monkeypatch):
    written, real = [], training.materialize
    monkeypatch.setattr(training, "materialize", lambda df: written.append(real(df)) or written[-1])
    xy = xy_written(spark, SF)
    training.train(xy, LinearParams("log", max_iter=2), None, ["AGE", "TOTAL_COMP"])
    assert tasks(written[0]) >= spark.sparkContext.defaultParallelism
    # an entity's rows stay together
    parts = written[0].select("CUST_ID", F.spark_partition_id().alias("P")).distinct()
    assert parts.count() == parts.select("CUST_ID").distinct().count() == xy.select("CUST_ID").distinct().count()


def test_range_windows_hold_active_customers_only(spark):
    dates = [D, D + timedelta(days=1)]
    cust = b.customer(spark, SF, dates)
    out = f.features_range(cust, b.account(spark, SF), b.events(spark, SF), dates, b.purchases(spark, SF))
    # names and places are not needed for a window, so they must not be sorted for one
    text = plan(out)
    windows = re.findall(r"\(\d+\) Window[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", text)
    assert windows and not any("EMAIL_DOMAIN" in columns or "BLOOD_GRP" in columns for columns in windows)
    assert out.count() == cust.count()
    active = b.events(spark, SF).select("CUST_ID").union(b.purchases(spark, SF).select("CUST_ID")).distinct()
    idle = out.join(active, "CUST_ID", "left_anti")
    assert idle.count() > 0
    assert idle.where("MAX_NUM_ACCT_7D is not null or NUM_EVENT_7D <> 0 or NUM_PUR_F7D <> 0 or TOTAL_PUR_AMT_F7D <> 0").count() == 0


def test_customers_of_many_dates_are_made_in_many_tasks(spark):
    assert "RoundRobin" not in plan(b.customer(spark, SF, [D]))
    # the dates are dealt out behind the shuffle
    text = plan(b.customer(spark, SF, [D, D + timedelta(days=1)]))
    assert text.index("Generate") < text.index("Exchange") and "REPARTITION_BY_NUM" in text
