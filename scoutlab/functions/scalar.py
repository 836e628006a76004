"""Scalar functions (F1-F11) as built-in Column expressions (JVM-side,
inside whole-stage codegen; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Difficulty classes of the puzzle rating, left-closed bins
# [-inf,1200) [1200,1800) [1800,2400) [2400,inf).
DIFFICULTY_EDGES = [1200, 1800, 2400]
DIFFICULTY_LABELS = ["Principiante", "Intermedio", "Avanzado", "Maestro"]

MISSING_MARKER = "FALTANTES"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_count(c: str | Column) -> Column:
    """whitespace token count (``str.split()``); null stays null.
    ``split('')`` yields one empty token, so empties are filtered out."""
    parts = F.split(F.trim(_c(c)), r"\s+")
    return F.size(F.filter(parts, lambda x: x != F.lit("")))


def first_token(c: str | Column) -> Column:
    """text before the first single space (the first move)."""
    return F.substring_index(_c(c), " ", 1)


def display_list(c: str | Column) -> Column:
    """``'a b c' -> 'a, b, c'``."""
    return F.replace(_c(c), F.lit(" "), F.lit(", "))


def bin_left_closed(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """half-open binning with +-inf ends, ``pd.cut(right=False)``."""
    x = _c(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(x < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[len(edges)]))


def bin_ordinal(c: str | Column, edges: Sequence[float]) -> Column:
    """Ordinal (0-based) of the left-closed bin; null stays null."""
    x = _c(c)
    expr = F.when(x.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(edges):
        expr = expr.when(x < F.lit(edge), F.lit(i))
    return expr.otherwise(F.lit(len(edges)))


def difficulty_class(c: str | Column = "Rating") -> Column:
    return bin_left_closed(c, DIFFICULTY_EDGES, DIFFICULTY_LABELS)


def difficulty_ordinal(c: str | Column = "Rating") -> Column:
    return bin_ordinal(c, DIFFICULTY_EDGES)


def log_target(c: str | Column) -> Column:
    """``log1p``; the inverse is :func:`expm1`."""
    return F.log1p(_c(c))


def inverse_log_target(c: str | Column) -> Column:
    return F.expm1(_c(c))


def percent(n: str | Column, total: str | Column, digits: int = 2) -> Column:
    """``round(100*n/total, digits)``; zero total -> null."""
    return F.round(F.try_divide(_c(n) * F.lit(100.0), _c(total)), digits)


def significant(p: str | Column, alpha: float = 0.05) -> Column:
    """significance flag."""
    return _c(p) < F.lit(alpha)
