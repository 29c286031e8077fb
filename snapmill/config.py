from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class EntityConfig:
    """Key columns of the snapshot tables and the target they predict."""

    entity_key: str = "CUST_ID"
    dt_key: str = "SNAP_DT"
    target_key: str = "CONV_7D"
    n_classes: int = 2

    @property
    def pk(self) -> list[str]:
        return [self.entity_key, self.dt_key]


DEFAULT = EntityConfig()


def past_days(d: date, n: int) -> list[date]:
    """The n days ending at d, oldest first."""
    return [d - timedelta(days=k) for k in range(n - 1, -1, -1)]


def days_between(start: date, end: date) -> list[date]:
    """Every day from start to end, both included."""
    return [start + timedelta(days=k) for k in range((end - start).days + 1)]
