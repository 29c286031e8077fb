"""Registration of queries together with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, digits: int) -> DataFrame:
    """Types both engines share: bigint, rounded double, zone-less timestamp, date, text, boolean."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            # adding zero turns a negative zero into zero
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a query; sql is its equivalent, absent where SQL cannot express the result."""
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir), digits)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap
