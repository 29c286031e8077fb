"""The daily run: check what a snapshot needs, create its table, compute, conform, insert, check.

Tables lie as <root>/<layer>/<table>, partitioned by snapshot date. A step reads only the partitions
that its upstreams name, so every source is pruned by date.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.operators import features as f
from snapmill.operators.coverage import Upstream, missing_upstreams, upstream_coverage
from snapmill.sources import schemas
from snapmill.sources.store import SnapshotTable

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """How one table's snapshot is made: its upstream dates and the query over them."""

    layer: str
    table: str
    upstreams: tuple[Upstream, ...]
    query: Callable[[Inputs, date], DataFrame]

    @property
    def name(self) -> str:
        return f"{self.layer}.{self.table}"


def _features(inputs: Inputs, d: date) -> DataFrame:
    return f.features(f.cust_base(inputs["EXTRACT.CUSTOMER"], d), f.acct_window(f.acct_base(inputs["EXTRACT.ACCOUNT"]), d),
                      f.event_window(inputs["EXTRACT.EVENTS"], d), d)


def _purchases(inputs: Inputs, d: date) -> DataFrame:
    return f.purchase_window(inputs["EXTRACT.PURCHASES"], d)


# the windows of events and purchases include midnight at their far end
FEATURES = Step("FEATURE", "FEATURES", (
    Upstream.current("EXTRACT.CUSTOMER"), Upstream.past("EXTRACT.ACCOUNT", 7), Upstream.past("EXTRACT.EVENTS", 8)), _features)
PURCHASE_WINDOW = Step("TARGET", "PURCHASE_WINDOW", (Upstream.future("EXTRACT.PURCHASES", 8),), _purchases)
STEPS = (FEATURES, PURCHASE_WINDOW)


class MissingUpstream(ValueError):
    """A snapshot's upstream partitions are not all there."""


class CheckFailed(ValueError):
    """A written snapshot broke a declared rule."""


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str
    cfg: EntityConfig = DEFAULT

    def table(self, name: str) -> SnapshotTable:
        layer, table = name.split(".")
        return SnapshotTable(self.spark, f"{self.root.rstrip('/')}/{layer}/{table}", self.cfg.dt_key,
                             schemas.declared_schema(layer, table))

    def load(self, name: str, df: DataFrame) -> None:
        """Conform rows of any dates to a table's schema and insert the dates it lacks."""
        layer, table = name.split(".")
        self.table(name).insert(schemas.schema_conform(df, schemas.declared_schema(layer, table)))

    def available(self, names: Iterable[str]) -> DataFrame:
        """(UPSTREAM, NEED_DT) of the snapshots that exist, from partition values alone."""
        out = self.spark.createDataFrame([], "UPSTREAM string, NEED_DT date")
        for name in names:
            table = self.table(name)
            if table.exists():
                out = out.unionByName(table.list_dates().select(F.lit(name).alias("UPSTREAM"), F.col(self.cfg.dt_key).alias("NEED_DT")))
        return out

    def inputs(self, step: Step, d: date) -> Inputs:
        """The upstream partitions of a date."""
        found = {}
        for u in step.upstreams:
            days = F.col(self.cfg.dt_key).between(F.lit(d + timedelta(days=u.first)), F.lit(d + timedelta(days=u.last)))
            found[u.table] = self.table(u.table).all().where(days)
        return found

    def run(self, step: Step, d: date, complete: bool = True) -> str:
        """Make one snapshot: 'present' if it was there already, else 'written'.

        complete: raise MissingUpstream unless every upstream partition exists; without it, at least one
        partition of each upstream must. The snapshot is written and checked before it becomes visible: one
        that breaks a check is discarded, and if another run has published the date meanwhile, that one stays.
        """
        target = self.table(step.name)
        if target.succeeded(d):
            return "present"
        wanted = self.spark.createDataFrame([(d,)], "SNAP_DT date")
        coverage = upstream_coverage(wanted, self.available({u.table for u in step.upstreams}), list(step.upstreams))
        missing = missing_upstreams(coverage)
        if not complete:
            have = coverage.where("IS_PRESENT").select("UPSTREAM").distinct()
            missing = missing.join(have, "UPSTREAM", "left_anti")
        gaps = [f"{r.UPSTREAM} {r.NEED_DT}" for r in missing.orderBy("UPSTREAM", "NEED_DT").limit(10).collect()]
        if gaps:
            raise MissingUpstream(f"{step.name} {d} needs {', '.join(gaps)}")
        schema = schemas.declared_schema(step.layer, step.table)
        version = target.stage(schemas.schema_conform(step.query(self.inputs(step, d), d), schema), d)
        required = [x.name for x in schema if not x.nullable]
        checks = schemas.post_check(target.staged(version), step.name, schemas.key_columns(schema), required)
        bad = [f"{r.check}: {r.n_bad}" for r in checks.where("n_bad > 0").collect()]
        if bad:
            target.discard(version)
            raise CheckFailed(f"{step.name} {d}: {', '.join(bad)}")
        if not target.publish(version, replace=False):
            target.discard(version)
            return "present"
        return "written"

    def run_range(self, steps: Iterable[Step], dates: Iterable[date], complete: bool = True) -> dict[tuple[str, date], str]:
        """Every step of every date, dates in order."""
        steps = list(steps)
        return {(s.name, d): self.run(s, d, complete) for d in sorted(dates) for s in steps}
