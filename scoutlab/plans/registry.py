"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL).

A plan builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
Double columns of every registered result are rounded to ``DIGITS``
decimals on both sides so that summation-order noise does not break the
value hash of the correctness check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column (presentation step only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, round_doubles: bool = True):
    """Register a plan builder (and its oracle SQL when SQL can express it)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return rounded(df) if round_doubles else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r(expr: str, digits: int = DIGITS) -> str:
    """Oracle-side rounding of one double expression."""
    return f"ROUND({expr}, {digits})"
