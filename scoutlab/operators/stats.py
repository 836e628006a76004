"""Kruskal-Wallis H test (G19, W3, F10) as distributed aggregation.

Average ranks come from the pooled value counts with a global cumulative
count (the two-level prefix sum in :func:`profile.value_ranks`), so no
window ever sees a whole column.  Per (variable, group) rank sums are then
a join of (variable, value, group) counts with (variable, value) ranks.
Only the final table — one row per variable — reaches the p-value helper.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from scoutlab.operators.profile import long_values, value_ranks


def chi2_sf(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution."""
    if x is None or df is None or df <= 0 or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if df % 2 == 0:  # closed form for even df
        h = x / 2.0
        term = total = 1.0
        for i in range(1, df // 2):
            term *= h / i
            total += term
        return math.exp(-h) * total
    # odd df: the normal tail, and the same sum at half-integer steps
    h = x / 2.0
    total, term = 0.0, math.sqrt(h) / math.gamma(1.5)
    for i in range(1, (df + 1) // 2):
        total += term
        term *= h / (i + 0.5)
    return math.erfc(math.sqrt(h)) + math.exp(-h) * total


@pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Arrow-batched p-value; applied to one row per tested variable."""
    return pd.Series([chi2_sf(float(a), int(b)) if pd.notna(a) and pd.notna(b) else float("nan")
                      for a, b in zip(x, dof)])


def kruskal_wallis(df: DataFrame, cols: Sequence[str], group: str, alpha: float = 0.05) -> DataFrame:
    """Tie-corrected Kruskal-Wallis H and p of each column across the
    groups of ``group`` (rows with a null value or group dropped per
    column).  Returns ``col_name, n, k, H, p_value, significant``."""
    data = df.filter(F.col(group).isNotNull())
    long = long_values(data, cols, by=[group])            # (group, col_name, value)
    pooled = long.select("col_name", "value")
    ranks = value_ranks(pooled)                           # (col_name, value, c, before, n)
    avg_rank = ranks.select("col_name", "value", "n",
                            (F.col("before") + (F.col("c") + 1) / 2.0).alias("avg_rank"),
                            (F.pow(F.col("c").cast("double"), 3) - F.col("c")).alias("tie"))
    per_vg = long.groupBy("col_name", "value", group).agg(F.count(F.lit(1)).alias("cg"))
    sums = (per_vg.join(avg_rank.select("col_name", "value", "avg_rank"), ["col_name", "value"])
            .groupBy("col_name", group)
            .agg(F.sum(F.col("cg") * F.col("avg_rank")).alias("R"), F.sum("cg").alias("ng")))
    per_var = sums.groupBy("col_name").agg(F.sum(F.pow("R", 2) / F.col("ng")).alias("s"),
                                           F.count(F.lit(1)).alias("k"))
    ties = avg_rank.groupBy("col_name").agg(F.sum("tie").alias("t"), F.first("n").alias("n"))
    n = F.col("n").cast("double")
    h_raw = F.lit(12.0) / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    h = F.try_divide(h_raw, F.lit(1.0) - F.try_divide(F.col("t"), F.pow(n, 3) - n))
    res = per_var.join(ties, "col_name").select("col_name", "n", "k", h.alias("H"))
    return (res.withColumn("p_value", chi2_sf_udf(F.col("H"), F.col("k") - 1))
            .withColumn("significant", F.col("p_value") < F.lit(alpha)))
