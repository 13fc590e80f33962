"""All queries of the core."""

from __future__ import annotations

from marketloom.plans import evaluation, ingest, market, search, streams, texts  # noqa: F401 - each registers its queries
from marketloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
