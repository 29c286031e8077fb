"""Which upstream snapshots a snapshot needs, and which of them are missing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Upstream:
    """Dates of an upstream table relative to the snapshot date: first..last, in days."""

    table: str
    first: int = 0
    last: int = 0

    @classmethod
    def current(cls, table: str) -> Upstream:
        return cls(table)

    @classmethod
    def past(cls, table: str, history: int, offset: int = 0) -> Upstream:
        """The history days that end at offset (0 is the date itself, -1 the day before)."""
        return cls(table, offset - history + 1, offset)

    @classmethod
    def future(cls, table: str, future: int, offset: int = 1) -> Upstream:
        """The future days that begin at offset."""
        return cls(table, offset, offset + future - 1)


# fixed values: what each feature and target table reads
UPSTREAMS = {
    "EXTRACT.EVENTS": [Upstream.past("RAW.EVENTS", 7, -1)],
    "EXTRACT.PURCHASES": [Upstream.past("RAW.PURCHASES", 7, -1)],
    "FEATURE.CUST_BASE": [Upstream.current("EXTRACT.CUSTOMER")],
    "FEATURE.ACCT_BASE": [Upstream.current("EXTRACT.ACCOUNT")],
    "FEATURE.ACCT_WINDOW": [Upstream.past("FEATURE.ACCT_BASE", 7)],
    "FEATURE.EVENT_WINDOW": [Upstream.past("EXTRACT.EVENTS", 7)],
    "FEATURE.FEATURES": [Upstream.current("FEATURE.CUST_BASE"), Upstream.current("FEATURE.ACCT_WINDOW"),
                         Upstream.current("FEATURE.EVENT_WINDOW")],
    "TARGET.PURCHASE_WINDOW": [Upstream.future("EXTRACT.PURCHASES", 7)],
    "TARGET.SCORING": [Upstream.current("FEATURE.FEATURES")],
}


def upstream_coverage(wanted: DataFrame, available: DataFrame, upstreams: list[Upstream]) -> DataFrame:
    """(SNAP_DT, UPSTREAM, NEED_DT, IS_PRESENT) for every wanted snapshot date.

    wanted has SNAP_DT, available has (UPSTREAM, NEED_DT): both are lists of partitions, not of
    rows.
    """
    needs = F.array(*[F.struct(F.lit(u.table).alias("UPSTREAM"), F.lit(u.first).alias("LO"), F.lit(u.last).alias("HI"))
                      for u in upstreams])
    required = (wanted.select("SNAP_DT", F.inline(needs))
                .select("SNAP_DT", "UPSTREAM",
                        F.explode(F.sequence(F.date_add("SNAP_DT", F.col("LO")), F.date_add("SNAP_DT", F.col("HI"))))
                        .alias("NEED_DT")))
    present = available.select("UPSTREAM", "NEED_DT").distinct().withColumn("IS_PRESENT", F.lit(True))
    return (required.join(present, ["UPSTREAM", "NEED_DT"], "left")
            .select("SNAP_DT", "UPSTREAM", "NEED_DT", F.coalesce("IS_PRESENT", F.lit(False)).alias("IS_PRESENT")))


def missing_upstreams(coverage: DataFrame) -> DataFrame:
    return coverage.where(~F.col("IS_PRESENT")).drop("IS_PRESENT")
