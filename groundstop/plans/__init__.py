"""Registered queries (``QUERIES``), their DuckDB oracles (``ORACLES``) and bench keys."""

from groundstop.plans import analytics, features_model, ingest_io, monitoring, streams  # noqa: F401  (registers queries)
from groundstop.plans.registry import BENCH, ORACLES, QUERIES

__all__ = ["BENCH", "ORACLES", "QUERIES"]
