"""Registered queries over the driver's tables and the SQL they are checked against."""

from snapmill.catalog import (  # noqa: F401
    engage_queries, feature_queries, model_queries, profile_queries, scoring_queries, table_queries,
)
from snapmill.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
