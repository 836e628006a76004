"""Typed filter builder (P6, P8-P12) returning ``Column`` predicates.

Predicates are built as Column expressions, never as interpolated SQL text,
so a quote in a league name cannot break the query and Catalyst can push
the comparisons on typed columns into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, functions as F


def numeric(c: str | Column) -> Column:
    """Text-or-number to double, bad values -> null (never raises)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def in_range(c: str, lo: float, hi: float, text: bool = False) -> Column:
    """Inclusive numeric range, for use in a filter: null fails it.

    A numeric column is compared as it is, so the range reaches the Parquet
    scan; ``text`` is for numbers held as text, where a non-number fails."""
    return (numeric(c) if text else F.col(c)).between(F.lit(lo), F.lit(hi))


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def in_list(c: str, values: Sequence[str] | None) -> Column:
    """Optional IN-list, skipped (true) when empty."""
    if not values:
        return F.lit(True)
    return F.col(c).isin(list(values))


def themes_any(c: str, themes: Sequence[str]) -> Column:
    """P10: any theme occurs as a substring, ASCII case-insensitive (SQLite
    ``LIKE '%t%'``).  No themes -> no restriction."""
    if not themes:
        return F.lit(True)
    low = F.lower(F.col(c))
    return F.coalesce(any_of(low.contains(t.lower()) for t in themes), F.lit(False))


def themes_all(c: str, themes: Sequence[str]) -> Column:
    """Every theme occurs as a literal substring, case-insensitive;
    null text -> false.  ``contains`` is literal, so no escaping is needed."""
    if not themes:
        return F.lit(True)
    low = F.lower(F.col(c))
    return F.coalesce(all_of(low.contains(t.lower()) for t in themes), F.lit(False))


@dataclass
class ScoutFilter:
    """The scouting page's WHERE clause (P8 + P9) as a typed builder.
    Defaults are the reference's slider ranges; value bounds are in
    millions and scaled to euros here."""

    value_m: tuple[float, float] = (0.0, 200.0)
    age: tuple[float, float] = (15.0, 45.0)
    height: tuple[float, float] = (150.0, 210.0)
    goals: tuple[float, float] = (0, 100)
    assists: tuple[float, float] = (0, 50)
    matches: tuple[float, float] = (0, 80)
    reds: tuple[float, float] = (0, 10)
    leagues: list[str] = field(default_factory=list)

    def column(self) -> Column:
        return all_of([
            in_range("valor_mercado_eur_TARGET", self.value_m[0] * 1_000_000, self.value_m[1] * 1_000_000),
            in_range("edad_al_momento", *self.age),
            in_range("altura_cm", *self.height),
            in_range("goles_12m", *self.goals),
            in_range("asistencias_12m", *self.assists),
            in_range("partidos_jugados_12m", *self.matches),
            in_range("tarjetas_rojas_12m", *self.reds),
            in_list("liga_actual", self.leagues),
        ])


@dataclass
class PuzzleFilter:
    """The puzzle page's WHERE clause: rating range (P12) plus themes, either
    any-of (SQL page, P10) or all-of (dashboard, P11)."""

    rating: tuple[int, int] = (1200, 2200)
    themes: list[str] = field(default_factory=list)
    mode: str = "any"

    def column(self) -> Column:
        theme_pred = themes_any if self.mode == "any" else themes_all
        return in_range("Rating", *self.rating) & theme_pred("Themes", self.themes)
