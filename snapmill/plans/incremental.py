"""Features day by day from stored partial states.

Per source and day one table partition holds the day's partial aggregates, one row per entity. A new date
reads the raw rows of that one day, adds their state, and merges the states of its trailing windows; the day
that leaves a window is simply not read any more. States are snapshot tables, so each day is published
atomically and a day that arrives again replaces its own state only.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import dt_lit
from snapmill.operators import features as f
from snapmill.sources.store import SnapshotTable

EVENT_COUNTS = ["NUM_EVENT_7D", "N_EMAIL", "N_CLICK", "N_DECLINE"]


@dataclass(frozen=True)
class FeatureStates:
    spark: SparkSession
    root: str
    cfg: EntityConfig = DEFAULT

    def _table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root.rstrip('/')}/{name}", self.cfg.dt_key)

    @property
    def accounts(self) -> SnapshotTable:
        return self._table("ACCT_DAY")

    @property
    def events(self) -> SnapshotTable:
        return self._table("EVENT_DAY")

    def add_day(self, d: date, account: DataFrame, events: DataFrame) -> None:
        """Fold the rows of one day into its states; both tables are filtered to that day before anything else.

        Only the event's own time counts, so a day whose events arrive in several batches is added again when
        the last one is there.
        """
        self.accounts.overwrite(f.acct_base(account, d, self.cfg), d)
        ts = F.col("EVENT_TS")
        of_day = events.where((ts >= dt_lit(d)) & (ts < dt_lit(d + timedelta(days=1))))
        state = f._daily_with_midnight(of_day, "EVENT_TS", f._event_counts(), EVENT_COUNTS, self.cfg)
        self.events.overwrite(state, d)

    def _between(self, table: SnapshotTable, first: date, last: date) -> DataFrame | None:
        if not table.exists():
            return None
        return table.all().where(F.col(self.cfg.dt_key).between(dt_lit(first), dt_lit(last)))

    def event_window(self, d: date) -> DataFrame | None:
        """Engagement of the trailing seven days: seven whole days and the midnight that ends them."""
        states = self._between(self.events, d - timedelta(days=f.LONG_DAYS), d)
        if states is None:
            return None
        day = F.col(self.cfg.dt_key)
        whole = day < dt_lit(d)

        def merged(name: str) -> F.Column:
            return F.sum(F.when(whole, F.col(name)).otherwise(F.coalesce(F.col(f"MID_{name}"), F.lit(0))))

        counted = F.when(whole, F.col("NUM_EVENT_7D")).otherwise(F.coalesce("MID_NUM_EVENT_7D", F.lit(0)))
        rows = (states.groupBy(self.cfg.entity_key)
                .agg(F.max(F.when(counted > 0, day)).alias("LAST_DAY"), *[merged(n).alias(n) for n in EVENT_COUNTS])
                .where("NUM_EVENT_7D > 0"))
        return rows.select(self.cfg.entity_key, dt_lit(d).alias(self.cfg.dt_key),
                           F.datediff(dt_lit(d), F.col("LAST_DAY")).alias("DAYS_SINCE_LAST_EVENT"), *f._event_ratios())

    def features(self, customer: DataFrame, d: date) -> DataFrame:
        """Features of d from the customers' snapshot of d and the stored states of its windows."""
        states = self._between(self.accounts, d - timedelta(days=f.LONG_DAYS - 1), d)
        event = self.event_window(d)
        if states is None or event is None:
            raise ValueError("no day has been added yet")
        return f.features(f.cust_base(customer, d, self.cfg), f.acct_window(states, d, self.cfg), event, d, self.cfg)

    def advance(self, dates: Iterable[date], account: DataFrame, events: DataFrame) -> None:
        """Add several days, oldest first; days that have a state already are left alone."""
        for d in sorted(dates):
            if not (self.accounts.succeeded(d) and self.events.succeeded(d)):
                self.add_day(d, account, events)
