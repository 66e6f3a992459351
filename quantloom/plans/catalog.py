"""All registered queries and their oracles."""

from __future__ import annotations

from quantloom.plans import model_queries, portfolio_queries, section_queries, source_queries, window_queries  # noqa: F401
from quantloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
