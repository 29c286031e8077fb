"""Carrying a snapshot forward to the next date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.config import DEFAULT, EntityConfig
from snapmill.functions.exprs import dt_lit, hash32
from snapmill.runtime import lookup_join


def roll_new_custs(customers: DataFrame, last_accounts: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Customers of today's snapshot without an account in yesterday's."""
    known = last_accounts.select(cfg.entity_key).distinct()
    return customers.join(known, cfg.entity_key, "left_anti")


def roll_keep_custs(accounts: DataFrame, customers: DataFrame, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """Accounts whose customer is still in the snapshot."""
    current = customers.select(cfg.entity_key).distinct()
    return accounts.join(current, cfg.entity_key, "left_semi")


def roll_drop_custs(customers: DataFrame, n: int, seed: int = 0, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """All but n customers, chosen as the n smallest hashes (a distributed top-n)."""
    dropped = (customers.select(cfg.entity_key, hash32(F.col(cfg.entity_key), seed).alias("H"))
               .orderBy("H", cfg.entity_key).limit(n).select(cfg.entity_key))
    return lookup_join(customers, dropped, [cfg.entity_key], "left_anti")


def roll_forward(last: DataFrame, d: date, new: DataFrame | None = None, cfg: EntityConfig = DEFAULT) -> DataFrame:
    """The last snapshot re-stamped with d, and the new rows appended."""
    carried = last.withColumn(cfg.dt_key, dt_lit(d))
    return carried if new is None else carried.unionByName(new.withColumn(cfg.dt_key, dt_lit(d)))
