"""All registered queries of the library, without the training-data operators."""

from __future__ import annotations

from firngrid.plans import catalog_queries, flow_queries, focal_queries, hazard_queries, source_queries, stats_queries  # noqa: F401
from firngrid.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
