"""Snapshot tables, declared schemas, the training registry and ad-hoc sources."""
