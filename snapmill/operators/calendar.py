"""Model calendar: half-open intervals [START_TS, END_TS) in which a model is in force.

A calendar has a handful of rows per model; the dates it is asked about can be many.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.runtime import lookup_join, materialize

COLUMNS = ["MODEL_ID", "START_TS", "END_TS"]
RANGE_ROWS = 5_000


def calendar_weeks(weeks: DataFrame) -> DataFrame:
    """Intervals [Monday, next Monday) of (MODEL_ID, ISO_YEAR, ISO_WEEK) rows."""
    # 4 January is always in ISO week 1
    first_monday = F.trunc(F.make_date(F.col("ISO_YEAR"), F.lit(1), F.lit(4)), "week")
    monday = F.date_add(first_monday, ((F.col("ISO_WEEK") - 1) * 7).cast("int"))
    return weeks.select("MODEL_ID", monday.cast("timestamp_ntz").alias("START_TS"),
                        F.date_add(monday, 7).cast("timestamp_ntz").alias("END_TS"))


def calendar_put(calendar: DataFrame, model_id: str, start: datetime, end: datetime) -> DataFrame:
    """Register an interval. Where it overlaps older ones it wins: they are trimmed or split."""
    if start >= end:
        raise ValueError("start must be before end")
    s, e = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    pieces = F.array(
        F.struct("MODEL_ID", "START_TS", F.least("END_TS", s).alias("END_TS")),
        F.struct("MODEL_ID", F.greatest("START_TS", e).alias("START_TS"), "END_TS"))
    rest = calendar.select(F.inline(F.filter(pieces, lambda p: p["START_TS"] < p["END_TS"])))
    new = calendar.sparkSession.range(1).select(F.lit(model_id).alias("MODEL_ID"), s.alias("START_TS"), e.alias("END_TS"))
    return rest.unionByName(new)


def calendar_gapfill(calendar: DataFrame, prod_id: str) -> DataFrame:
    """The schedule in order of START_TS, with the gaps between intervals given to prod_id.

    A gap begins where all earlier intervals have ended, also where one lies inside another.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("START_TS", "END_TS")
    reach = F.max("END_TS").over(order.rowsBetween(Window.unboundedPreceding, 0))
    gap = F.when(F.col("REACH") < F.col("NEXT"), F.struct(
        F.lit(prod_id).alias("MODEL_ID"), F.col("REACH").alias("START_TS"), F.col("NEXT").alias("END_TS")))
    rows = calendar.withColumns({"NEXT": F.lead("START_TS").over(order), "REACH": reach})
    return (rows.select(F.inline(F.array_compact(F.array(F.struct(*COLUMNS), gap))))
            .orderBy("START_TS"))


def model_pick(dates: DataFrame, calendar: DataFrame, dt: str, prod_id: str | None = None) -> DataFrame:
    """dates with the MODEL_ID in force at 00:00 of dt; outside every interval the production model.

    A calendar of at most RANGE_ROWS intervals is broadcast and compared as ranges. Beyond that the distinct
    dates and the interval starts are swept in one order (in_force). Intervals must not overlap, as
    calendar_put keeps them. Fails when a date has no model and there is no production model.
    """
    fallback = F.lit(prod_id) if prod_id is not None else F.raise_error(
        F.lit("no model in the calendar or in production for a date")).cast("string")
    calendar = materialize(calendar.select(*COLUMNS))
    if calendar.limit(RANGE_ROWS + 1).count() <= RANGE_ROWS:
        at = F.col(dt).cast("timestamp_ntz")
        found = dates.join(F.broadcast(calendar), (at >= F.col("START_TS")) & (at < F.col("END_TS")), "left")
        return found.select(*dates.columns, F.coalesce("MODEL_ID", fallback).alias("MODEL_ID"))
    picked = lookup_join(dates, in_force(dates.select(dt).where(F.col(dt).isNotNull()).distinct(), calendar, dt), [dt])
    return picked.withColumn("MODEL_ID", F.coalesce("MODEL_ID", fallback))


def in_force(days: DataFrame, calendar: DataFrame, dt: str) -> DataFrame:
    """(dt, MODEL_ID) of the distinct days that lie in an interval, by a sweep.

    Interval starts and midnights form one order in range partitions. A midnight takes the last interval
    that started before it, from its own partition or, over a table with one row per partition, from an
    earlier one, and keeps it if it has not ended. Work is the sort; an interval of any length is one row.
    """
    n = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    interval = F.struct("START_TS", "END_TS", "MODEL_ID")
    starts = calendar.where("START_TS < END_TS").select(F.col("START_TS").alias("_AT"), F.lit(0).alias("_KIND"), interval.alias("_LAST"),
                                                        F.lit(None).cast("date").alias(dt))
    asked = days.select(F.col(dt).cast("timestamp_ntz").alias("_AT"), F.lit(1).alias("_KIND"),
                        F.lit(None).cast(starts.schema["_LAST"].dataType).alias("_LAST"), F.col(dt).cast("date").alias(dt))
    # a start at a midnight comes before it
    ranged = materialize(starts.unionByName(asked).repartitionByRange(n, "_AT", "_KIND").withColumn("_PART", F.spark_partition_id()))
    # one row per partition: its last start, and the last one of all earlier partitions
    lasts = ranged.groupBy("_PART").agg(F.max_by("_LAST", F.when(F.col("_KIND") == 0, F.struct("_AT", "_LAST"))).alias("_TOP"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_PART").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("_PART", F.last("_TOP", ignorenulls=True).over(earlier).alias("_CARRIED"))
    so_far = Window.partitionBy("_PART").orderBy("_AT", "_KIND", "_LAST").rowsBetween(Window.unboundedPreceding, 0)
    found = ranged.join(F.broadcast(carried), "_PART").withColumn("_OPEN", F.coalesce(F.last("_LAST", ignorenulls=True).over(so_far), "_CARRIED"))
    return found.where((F.col("_KIND") == 1) & (F.col("_AT") < F.col("_OPEN.END_TS"))).select(dt, F.col("_OPEN.MODEL_ID").alias("MODEL_ID"))
