"""Registered query plans over the driver's test tables.

Importing this package registers every plan in ``registry.QUERIES`` and its
DuckDB oracle SQL (where SQL can express it) in ``registry.ORACLE``.
"""

from scoutlab.plans import chess, football, imputation, io_plans, modeling, players, profiling, puzzles  # noqa: F401
from scoutlab.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
