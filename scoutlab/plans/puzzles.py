"""Puzzle page plans (L3 chess tab, L4 dashboard) on the puzzle stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlab.functions import scalar as fn
from scoutlab.functions.predicates import PuzzleFilter
from scoutlab.operators import puzzles as Z
from scoutlab.plans import standins as S
from scoutlab.plans.positions import positions_sql
from scoutlab.plans.registry import query, r
from scoutlab.sources.io import table

ANY = PuzzleFilter(rating=(1200, 2200), themes=["large", "Gear"], mode="any")
ALL = PuzzleFilter(rating=(1000, 2600), themes=["SMALL", "bolt"], mode="all")

_W_ANY = ("COALESCE(TRY_CAST(Rating AS DOUBLE) BETWEEN 1200 AND 2200, false) AND "
          "COALESCE(lower(Themes) LIKE '%large%' OR lower(Themes) LIKE '%gear%', false)")
_W_ALL = ("COALESCE(TRY_CAST(Rating AS DOUBLE) BETWEEN 1000 AND 2600, false) AND "
          "COALESCE(contains(lower(Themes), 'small') AND contains(lower(Themes), 'bolt'), false)")
WITH = S.sql_cte("puzzles")


def muestra(spark, d):
    return S.puzzles(spark, d)


@query("themes_any", sql=WITH + f"SELECT PuzzleId, Rating, Themes FROM puzzles WHERE {_W_ANY}")
def q_themes_any(spark, d):
    """P10 + P12: any-of themes, case-insensitive substring."""
    return Z.filtered(muestra(spark, d), ANY).select("PuzzleId", "Rating", "Themes")


@query("themes_all", sql=WITH + f"""
SELECT PuzzleId, Rating, Popularity, NbPlays, Themes FROM puzzles WHERE {_W_ALL}
ORDER BY PuzzleId LIMIT 20""")
def q_themes_all(spark, d):
    """P11 + P12 + T9: all-of themes, first 20 by key."""
    return Z.puzzle_list(muestra(spark, d), ALL, n=20).select(
        "PuzzleId", "Rating", "Popularity", "NbPlays", "Themes")


@query("puzzle_averages", sql=WITH + f"""
SELECT ROUND(AVG(Rating), 2) AS Rating_Promedio, ROUND(AVG(Popularity), 2) AS Popularidad_Promedio
FROM puzzles WHERE {_W_ANY}""")
def q_puzzle_averages(spark, d):
    """q2_a."""
    return Z.puzzle_averages(muestra(spark, d), ANY)


@query("most_played_top5", sql=WITH + f"""
SELECT PuzzleId, CAST(NbPlays AS INT) AS Numero_Jugadas, Rating FROM puzzles WHERE {_W_ANY}
ORDER BY Numero_Jugadas DESC NULLS LAST, PuzzleId LIMIT 5""")
def q_most_played(spark, d):
    """q3_a."""
    return Z.most_played_top5(muestra(spark, d), ANY)


@query("puzzles_by_popularity", sql=WITH + f"""
SELECT Popularity, COUNT(*) AS Cantidad_Puzzles, ROUND(AVG(Rating), 2) AS Rating_Promedio
FROM puzzles WHERE {_W_ANY} GROUP BY Popularity
ORDER BY Cantidad_Puzzles DESC, Popularity NULLS FIRST LIMIT 5""")
def q_by_popularity(spark, d):
    """q4_a."""
    return Z.puzzles_by_popularity(muestra(spark, d), ANY)


@query("deviation_frequency", sql=WITH + f"""
SELECT RatingDeviation, COUNT(*) AS Frecuencia FROM puzzles WHERE {_W_ANY}
GROUP BY RatingDeviation ORDER BY Frecuencia DESC, RatingDeviation NULLS FIRST LIMIT 5""")
def q_deviation(spark, d):
    """q5_a."""
    return Z.deviation_frequency(muestra(spark, d), ANY)


@query("chess_kpis", sql=WITH + f"""
SELECT COUNT(*) AS n_puzzles, {r('AVG(Rating)')} AS mean_rating, {r('AVG(Popularity)')} AS mean_popularity,
       CAST(COALESCE(SUM(NbPlays), 0) AS BIGINT) AS total_plays FROM puzzles""")
def q_chess_kpis(spark, d):
    """A7."""
    return Z.chess_kpis(muestra(spark, d))


_CLASS_SQL = ("CASE WHEN Rating IS NULL THEN NULL WHEN Rating < 1200 THEN 'Principiante' "
              "WHEN Rating < 1800 THEN 'Intermedio' WHEN Rating < 2400 THEN 'Avanzado' ELSE 'Maestro' END")


@query("difficulty_class", sql=WITH + f"""
SELECT PuzzleId, Rating, {_CLASS_SQL} AS nivel_dificultad,
       CASE WHEN Rating < 1200 THEN 0 WHEN Rating < 1800 THEN 1 WHEN Rating < 2400 THEN 2 ELSE 3 END
         AS nivel_ordinal FROM puzzles""")
def q_difficulty_class(spark, d):
    """left-closed binning with labels."""
    return muestra(spark, d).select("PuzzleId", "Rating",
                                    fn.difficulty_class("Rating").alias("nivel_dificultad"),
                                    fn.difficulty_ordinal("Rating").alias("nivel_ordinal"))


@query("class_balance", sql=WITH + f"""
, labels(class_order, nivel_dificultad) AS (VALUES (0, 'Principiante'), (1, 'Intermedio'), (2, 'Avanzado'), (3, 'Maestro')),
c AS (SELECT {_CLASS_SQL} AS nivel_dificultad, COUNT(*) AS n FROM puzzles GROUP BY 1),
t AS (SELECT COUNT(*) AS total FROM puzzles)
SELECT l.class_order, l.nivel_dificultad, COALESCE(c.n, 0) AS n,
       COALESCE(ROUND(COALESCE(c.n, 0) * 100.0 / t.total, 2), 0.0) AS pct
FROM labels l LEFT JOIN c USING (nivel_dificultad), t""")
def q_class_balance(spark, d):
    """A15."""
    return Z.class_balance(muestra(spark, d))


@query("token_counts", sql="""
SELECT doc_id, len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')) AS n_tokens
FROM documents""")
def q_token_counts(spark, d):
    """F1 on whole document texts."""
    return table(spark, d, "documents").select("doc_id", fn.token_count("text").alias("n_tokens"))


_WITH_POS = WITH + ", " + positions_sql() + """,
m AS (SELECT p.*, f.FEN, f.Moves FROM puzzles p JOIN fixture_positions f USING (position_no))
"""


@query("first_token", sql=_WITH_POS + """
SELECT PuzzleId, split_part(Moves, ' ', 1) AS first_move, replace(Themes, ' ', ', ') AS themes_display FROM m""")
def q_first_token(spark, d):
    """first move of the move list; themes for display."""
    return Z.first_token_view(S.puzzles_with_positions(spark, d))


@query("puzzle_token_counts", sql=_WITH_POS + """
SELECT PuzzleId,
  len(list_filter(regexp_split_to_array(trim(Moves), '\\s+'), lambda x: x <> '')) AS num_movimientos,
  len(list_filter(regexp_split_to_array(trim(Themes), '\\s+'), lambda x: x <> '')) AS num_temas,
  CASE WHEN Rating < 1200 THEN 'Principiante' WHEN Rating < 1800 THEN 'Intermedio'
       WHEN Rating < 2400 THEN 'Avanzado' ELSE 'Maestro' END AS nivel_dificultad FROM m""")
def q_puzzle_token_counts(spark, d):
    """F1 + F4 on the puzzle table (num_movimientos, num_temas, class)."""
    return Z.with_derived(S.puzzles_with_positions(spark, d)).select(
        "PuzzleId", "num_movimientos", "num_temas", "nivel_dificultad")


@query("log_target", sql=S.sql_cte("player_obs") + f"""
SELECT obs_id, {r('ln(1 + valor_mercado_eur_TARGET)')} AS log_value,
       {r('exp(ln(1 + valor_mercado_eur_TARGET)) - 1', 2)} AS value_back FROM player_obs""")
def q_log_target(spark, d):
    """log1p and its inverse."""
    df = S.player_obs(spark, d)
    lv = fn.log_target("valor_mercado_eur_TARGET")
    return df.select("obs_id", lv.alias("log_value"),
                     F.round(fn.inverse_log_target(lv), 2).alias("value_back"))
