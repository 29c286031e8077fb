"""Daily customer-snapshot analytics on Spark DataFrames."""

from snapmill.config import EntityConfig

__all__ = ["EntityConfig"]
