"""Registered queries: each composes operators over the driver's tables and has,
where the result can be written in SQL, an equivalent DuckDB query."""

from pickwise.plans.registry import QUERIES, ORACLES, register

__all__ = ["QUERIES", "ORACLES", "register"]
