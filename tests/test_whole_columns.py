"""Queries take every column that they are named for."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from scoutlab.functions import scalar as fn
from scoutlab.operators.chess import features as CF
from scoutlab.plans import standins as S

from conftest import SF_SMALL


def test_feature_matrix_holds_every_column(spark):
    got = E.queries()["feature_matrix"](spark, SF_SMALL).cache()
    train = S.player_obs(spark, SF_SMALL).join(got.filter("NOT is_test").select("obs_id"), "obs_id", "left_semi")
    kinds = train.agg(*[F.count_distinct(F.coalesce(c, F.lit("FALTANTES"))) for c in S.PLAYER_TEXT]).first()
    # A category column has one more slot, for values that the training rows lack.
    assert {len(r.features) for r in got.select("features").collect()} == {len(S.PLAYER_NUMERIC) - 1 + sum(kinds) + len(kinds)}


@pytest.fixture(scope="module")
def puzzles(spark):
    """Every row measured on its own."""
    df = CF.chess_features(S.puzzles_with_positions(spark, SF_SMALL))
    df = df.withColumn("nivel_dificultad", fn.difficulty_class("Rating")).toPandas()
    return df.assign(num_movimientos=df["Moves"].str.split().str.len(), num_temas=df["Themes"].str.split().str.len())


VARIABLES = ["RatingDeviation", "Popularity", "NbPlays", "num_movimientos", "num_temas", "branching_factor", "forcing_index",
             "graph_density", "tension_components", "spatial_entropy", "com_chebyshev_dist"]


def test_kruskal_wallis_of_all_puzzle_variables(spark, puzzles):
    got = {r.col_name: r for r in E.queries()["kruskal_wallis_puzzles"](spark, SF_SMALL).collect()}
    assert sorted(got) == sorted(VARIABLES)
    n = len(puzzles)
    for c in VARIABLES:
        ranks, ties = puzzles[c].rank(), puzzles[c].value_counts()
        sums = ranks.groupby(puzzles["nivel_dificultad"]).agg(["sum", "count"])
        h = 12 / (n * (n + 1)) * (sums["sum"] ** 2 / sums["count"]).sum() - 3 * (n + 1)
        tied = 1 - (ties ** 3 - ties).sum() / (n ** 3 - n)
        assert got[c].n == n and (got[c].H is None if tied == 0 else got[c].H == pytest.approx(h / tied, abs=1e-5))


def test_boxplot_of_all_puzzle_variables_by_difficulty(spark, puzzles):
    got = {(r.nivel_dificultad, r.col_name): (r.n, r.median) for r in E.queries()["boxplot_by_difficulty"](spark, SF_SMALL).collect()}
    want = {(k, c): (len(g), g[c].median()) for k, g in puzzles.groupby("nivel_dificultad") for c in ["Rating", *VARIABLES]}
    assert sorted(got) == sorted(want) and all(got[k] == (want[k][0], pytest.approx(want[k][1], abs=1e-6)) for k in want)


def test_the_band_weighs_every_row_in_every_replicate(spark):
    """G13b against plain digests, row by row; keys of several lengths, one beyond a digest's block."""
    import hashlib
    import numpy as np
    from scoutlab.operators import profile as G
    rows = [(k, float(i % 7), float(3 * i + i % 5)) for i, k in enumerate([*map(str, range(5, 125)), "x" * 60, "é", None])]
    df = spark.createDataFrame([*rows, ("gap", None, 1.0)], "k string, x double, y double")
    lines = []
    for b in range(1, 31):
        draws = [int(hashlib.md5(":".join([*([k] if k is not None else []), str(b), "42"]).encode()).hexdigest()[:8], 16) / 2**32 for k, _, _ in rows]
        w = np.array([sum(t <= u for t in G.poisson_thresholds()) for u in draws], float)
        x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        m = (w.sum() * (w * x * y).sum() - (w * x).sum() * (w * y).sum()) / (w.sum() * (w * x * x).sum() - (w * x).sum() ** 2)
        lines.append((m, ((w * y).sum() - m * (w * x).sum()) / w.sum()))
    got = G.regression_band(df, "x", "y", "k", replicates=30, grid_points=4).orderBy("i").collect()
    for r in got:
        fits = [m * r.gx + c for m, c in lines]
        assert (r.gx, r.lower, r.upper) == pytest.approx((2.0 * r.i, np.quantile(fits, 0.025), np.quantile(fits, 0.975)))
    assert len(got) == 4
