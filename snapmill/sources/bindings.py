"""RAW snapshot views derived from the driver's tables.

``events`` is the only dense time series there, so accounts, engagement events and purchases
come from it; customers come from ``customer``.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.functions.exprs import dt_lit
from snapmill.runtime import spread

REFERENCE_DATE = date(2024, 1, 15)

MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumns({
        "k": F.get_json_object("props", "$.k").cast("int"),
        "v": F.col("value").cast(MONEY),
        "day": F.col("ts").cast("date"),
    })


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    type_code = (F.when(kind == "view", "CHQ").when(kind == "click", "SAV").when(kind == "purchase", "CRD")
                 .when(kind == "signup", "LN").otherwise("MTG"))
    return _events(spark, sf_dir).select(
        F.col("user_id").alias("CUST_ID"),
        F.col("event_id").cast("string").alias("ACCT_ID"),
        F.col("day").alias("SNAP_DT"),
        type_code.alias("ACCT_TYPE_CD"),
        F.col("v").alias("END_BAL"),
        (F.col("v") * (F.col("k") % 10)).cast(MONEY).alias("DR_AMT"),
        (F.col("v") * (F.col("k") % 7)).cast(MONEY).alias("CR_AMT"),
        F.when(kind.isin("view", "click"), F.lit(None)).otherwise(F.col("v") * 2 + 100).cast(MONEY).alias("CR_LMT"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return _events(spark, sf_dir).where(kind != "purchase").select(
        F.col("user_id").alias("CUST_ID"),
        F.col("day").alias("SNAP_DT"),
        F.col("ts").alias("EVENT_TS"),
        F.when(F.col("k") % 10 < 7, "E").otherwise("P").alias("EVENT_CHANNEL"),
        F.when(kind == "click", "C").when(kind == "error", "D").otherwise("O").alias("EVENT_CD"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("CUST_ID"),
        F.col("day").alias("SNAP_DT"),
        F.col("ts").alias("PUR_TS"),
        (F.col("k") % 14 + 1).cast("bigint").alias("PUR_NUM"),
        F.col("value").cast("decimal(10,2)").alias("PUR_AMT"),
    )


def customer(spark: SparkSession, sf_dir: str, dates: Iterable[date] = (REFERENCE_DATE,)) -> DataFrame:
    """One snapshot of every customer for each date."""
    k = F.col("c_custkey")

    def pick(index, values):
        out = F.when(index == 0, F.lit(values[0]))
        for i, v in enumerate(values[1:], 1):
            out = out.when(index == i, F.lit(v))
        return out

    salary = F.greatest(F.col("c_acctbal"), F.lit(0.0)).cast("decimal(10,2)")
    email = F.concat(F.lit("u"), k.cast("string"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    dates = list(dates)
    snap_dt = dt_lit(dates[0]) if len(dates) == 1 else F.explode(F.array(*[dt_lit(d) for d in dates]))
    rows = table(spark, sf_dir, "customer")
    # a small file is one task, which would make every row of every date
    return (rows if len(dates) == 1 else spread(rows, "c_custkey")).select(
        k.alias("CUST_ID"),
        snap_dt.alias("SNAP_DT"),
        F.col("c_name").alias("NAME"),
        pick(k % 2, ["F", "M"]).alias("GENDER"),
        F.date_add(F.lit(date(1960, 1, 1)), (k * 37 % 15000).cast("int")).alias("BIRTH_DT"),
        F.when(k % 3 == 0, F.concat(F.lit("555-"), k.cast("string"))).alias("PHONE"),
        F.when(k % 11 != 0, email).alias("EMAIL"),
        pick(k % 9, ["A+", "A-", "AB+", "AB-", "B+", "B-", "O+", "O-"]).alias("BLOOD_GRP"),
        F.col("c_mktsegment").alias("JOB"),
        pick(F.col("c_nationkey") % 4, ["New York", " Austin", "Seattle", "Chicago "]).alias("OFFICE"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("ADDRESS"),
        pick(k % 5, ["Sales", "Devops", "Platform", "Product"]).alias("ORG"),
        pick(k % 4, ["Engineer", "Manager", "VP", "Associate"]).alias("TITLE"),
        F.date_add(F.lit(date(2002, 1, 1)), (k * 53 % 8000).cast("int")).alias("SINCE_DT"),
        salary.alias("SALARY"),
        F.when(k % 13 != 0, salary * (k % 3)).cast("decimal(10,2)").alias("BONUS"),
    )
