"""Statistical test and model-preparation plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlab.functions import scalar as fn
from scoutlab.operators import mlprep as M
from scoutlab.operators import profile as G
from scoutlab.operators import stats as K
from scoutlab.operators.chess import features as CF
from scoutlab.plans import standins as S
from scoutlab.plans.registry import query, r
from scoutlab.session import checkpoint_dir

WITH = S.sql_cte("player_obs")
KW_COLS = S.PLAYER_NUMERIC
GROUP = "posicion_principal"


def obs(spark, d):
    return S.player_obs(spark, d)


def _kw_sql(c: str) -> str:
    return f"""SELECT '{c}' AS col_name, n, k,
  {r('(12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (CAST(n AS DOUBLE) * n * n - n))')} AS H,
  {r('EXP(-((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (CAST(n AS DOUBLE) * n * n - n))) / 2) * '
     '(1 + ((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (CAST(n AS DOUBLE) * n * n - n))) / 2)')} AS p_value,
  EXP(-((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (CAST(n AS DOUBLE) * n * n - n))) / 2) *
    (1 + ((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (CAST(n AS DOUBLE) * n * n - n))) / 2) < 0.05
    AS significant
FROM (SELECT
  (SELECT SUM(R * R / ng) FROM (SELECT g, SUM(avg_rank) AS R, COUNT(*) AS ng FROM
     (SELECT {GROUP} AS g, {c} AS v FROM player_obs WHERE {GROUP} IS NOT NULL AND {c} IS NOT NULL) d
     JOIN (SELECT v, SUM(c) OVER (ORDER BY v) - c + (c + 1) / 2.0 AS avg_rank FROM
           (SELECT {c} AS v, COUNT(*) AS c FROM player_obs WHERE {GROUP} IS NOT NULL AND {c} IS NOT NULL GROUP BY 1))
     USING (v) GROUP BY g)) AS s,
  (SELECT COUNT(DISTINCT {GROUP}) FROM player_obs WHERE {GROUP} IS NOT NULL AND {c} IS NOT NULL) AS k,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM player_obs WHERE {GROUP} IS NOT NULL AND {c} IS NOT NULL) AS n,
  (SELECT SUM(CAST(c AS DOUBLE) * c * c - c) FROM (SELECT COUNT(*) AS c FROM player_obs
     WHERE {GROUP} IS NOT NULL AND {c} IS NOT NULL GROUP BY {c})) AS t)"""


@query("kruskal_wallis", sql=WITH + "\nUNION ALL ".join(_kw_sql(c) for c in KW_COLS))
def q_kruskal(spark, d):
    """G19 + W3 + F10: H and p per variable across 5 position groups."""
    return K.kruskal_wallis(obs(spark, d), KW_COLS, GROUP)


# Every numeric variable but Rating, from which the class is derived.
KW_PUZZLE_COLS = ["RatingDeviation", "Popularity", "NbPlays", "num_movimientos", "num_temas", *CF.EMPTY_FEATURES]


def puzzles_measured(spark, d):
    """The puzzles with class, counts and chess features.  The features depend on
    FEN and Moves alone, so each different pair is measured once."""
    df = S.puzzles_with_positions(spark, d).select("Rating", "RatingDeviation", "Popularity", "NbPlays", "Themes", "FEN", "Moves")
    pairs = df.select("FEN", "Moves").distinct().withColumnsRenamed({"FEN": "_fen", "Moves": "_moves"})
    checkpoint_dir(spark)
    measured = CF.chess_features(pairs, "_fen", "_moves").checkpoint(eager=True)
    return (df.join(measured, F.col("FEN").eqNullSafe(F.col("_fen")) & F.col("Moves").eqNullSafe(F.col("_moves")))
            .withColumn("nivel_dificultad", fn.difficulty_class("Rating"))
            .withColumn("num_movimientos", fn.token_count("Moves")).withColumn("num_temas", fn.token_count("Themes")))


@query("kruskal_wallis_puzzles")
def q_kruskal_puzzles(spark, d):
    """G19 of all eleven variables on the puzzle stand-in against the difficulty
    class (4 classes, odd df: p from the regularized incomplete gamma; rows-only check)."""
    return K.kruskal_wallis(puzzles_measured(spark, d), KW_PUZZLE_COLS, "nivel_dificultad")


@query("boxplot_by_difficulty")
def q_boxplot_by_difficulty(spark, d):
    """Every numeric variable of the puzzles per difficulty class (rows-only check)."""
    return G.boxplot_stats(puzzles_measured(spark, d), ["Rating", *KW_PUZZLE_COLS], by=["nivel_dificultad"])


def _first(key: str, src: str) -> str:
    """SQL for the seeded test side over the distinct ``key`` values of ``src``."""
    return (f"(SELECT {key}, row_number() OVER (ORDER BY md5(concat_ws(':', CAST({key} AS VARCHAR), '42')), {key}) "
            f"<= CEIL(0.2 * COUNT(*) OVER ()) AS is_test FROM (SELECT DISTINCT {key} FROM {src} WHERE {key} IS NOT NULL))")


@query("train_test_split", sql=WITH + f"SELECT obs_id, player_id, is_test FROM player_obs JOIN {_first('obs_id', 'player_obs')} USING (obs_id)")
def q_split(spark, d):
    """Seeded exact-size 80/20 split."""
    return M.train_test_split(obs(spark, d).select("obs_id", "player_id"), "obs_id")


@query("split_sizes", sql=WITH + """
SELECT is_test, n_rows FROM (SELECT true AS is_test, CAST(CEIL(0.2 * COUNT(*)) AS BIGINT) AS n_rows FROM player_obs
UNION ALL SELECT false, CAST(COUNT(*) - CEIL(0.2 * COUNT(*)) AS BIGINT) FROM player_obs)""")
def q_split_sizes(spark, d):
    """G22 size contract."""
    s = M.train_test_split(obs(spark, d).select("obs_id"), "obs_id")
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("n_rows"))


@query("group_split", sql=WITH + f"SELECT obs_id, player_id, is_test FROM player_obs LEFT JOIN {_first('player_id', 'player_obs')} USING (player_id)")
def q_group_split(spark, d):
    """Split by player."""
    return M.group_split(obs(spark, d).select("obs_id", "player_id"), "player_id")


@query("group_split_sizes", sql=WITH + """
SELECT is_test, n_groups, 0 AS n_shared FROM (
  SELECT true AS is_test, CAST(CEIL(0.2 * COUNT(DISTINCT player_id)) AS BIGINT) AS n_groups FROM player_obs
  UNION ALL SELECT false, CAST(COUNT(DISTINCT player_id) - CEIL(0.2 * COUNT(DISTINCT player_id)) AS BIGINT)
  FROM player_obs)""")
def q_group_split_sizes(spark, d):
    """A18 + G23: distinct groups per side and groups found on both sides."""
    s = M.group_split(obs(spark, d).select("obs_id", "player_id"), "player_id")
    per = s.groupBy("is_test").agg(F.count_distinct("player_id").alias("n_groups"))
    shared = (s.groupBy("player_id").agg(F.count_distinct("is_test").alias("sides"))
              .agg(F.count_if(F.col("sides") > 1).alias("n_shared")))
    return per.join(F.broadcast(shared))  # one row


SCALE_COLS = S.PLAYER_NUMERIC


@query("standard_scale", sql=WITH + "SELECT obs_id, " + ", ".join(
    f"{r(f'({c} - (SELECT AVG({c}) FROM player_obs)) / COALESCE(NULLIF((SELECT STDDEV_POP({c}) FROM player_obs), 0), 1)')} AS {c}"
    for c in SCALE_COLS) + " FROM player_obs")
def q_standard_scale(spark, d):
    """Population-std scaling (fitted on the whole table here)."""
    df = obs(spark, d).select("obs_id", *SCALE_COLS)
    return M.standard_scale(df, M.scaler_stats(df, SCALE_COLS))


@query("one_hot", sql=WITH + "SELECT obs_id, pie_habil, " + ", ".join(
    f"CAST(COALESCE(pie_habil, 'FALTANTES') = '{c}' AS DOUBLE) AS pie_habil_{c}"
    for c in ["FALTANTES", "both", "left", "right"]) + " FROM player_obs")
def q_one_hot(spark, d):
    """One-hot with sorted categories and a null marker."""
    df = obs(spark, d).select("obs_id", "pie_habil")
    return M.one_hot_columns(df, "pie_habil", M.categories(df, "pie_habil"))


MATRIX_COLS = [c for c in S.PLAYER_NUMERIC if c != "valor_mercado_eur_TARGET"]


@query("feature_matrix")
def q_feature_matrix(spark, d):
    """G26 + G27: train-fitted scaler + one-hot assembled into a vector
    (rows-only: vector column, engine-specific split)."""
    df = obs(spark, d).withColumn("log_target", fn.log_target("valor_mercado_eur_TARGET"))
    out = M.feature_matrix(df, "obs_id", "log_target",
                           num_cols=MATRIX_COLS, cat_cols=S.PLAYER_TEXT,
                           drop=["valor_mercado_eur_TARGET", "id_observacion", "player_id"])
    return out.withColumn("features", M.dense())


def _matrix_sql(split: str) -> str:
    """The rows of the matrix as text, numbers to 6 decimals."""
    def text(x: str) -> str:
        return f"CAST(CAST(round({x}, 6) AS DECIMAL(20, 6)) AS VARCHAR)"
    numbers = [f"coalesce({text(f'(p.{c} - t.m_{c}) / coalesce(nullif(t.s_{c}, 0), 1)')}, 'NaN')" for c in MATRIX_COLS]
    cats = [f"array_to_string(list_transform(t.c_{c}, lambda x: CASE WHEN x = coalesce(p.{c}, 'FALTANTES') THEN '1' ELSE '0' END), ',') "
            f"|| CASE WHEN list_contains(t.c_{c}, coalesce(p.{c}, 'FALTANTES')) THEN ',0' ELSE ',1' END" for c in S.PLAYER_TEXT]
    fitted = [f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in MATRIX_COLS]
    fitted += [f"list_sort(list(DISTINCT coalesce({c}, 'FALTANTES'))) AS c_{c}" for c in S.PLAYER_TEXT]
    return WITH + f""", p AS (SELECT player_obs.*, is_test FROM player_obs LEFT JOIN {split}),
t AS (SELECT {', '.join(fitted)} FROM p WHERE NOT is_test)
SELECT obs_id, is_test, {r('ln(1 + valor_mercado_eur_TARGET)')} AS log_target, {" || ',' || ".join(numbers + cats)} AS features FROM p, t"""


def _matrix_text(spark, d, group=None):
    df = obs(spark, d).withColumn("log_target", fn.log_target("valor_mercado_eur_TARGET"))
    out = M.feature_matrix(df, "obs_id", "log_target", num_cols=MATRIX_COLS, cat_cols=S.PLAYER_TEXT, group=group)
    out = out.withColumn("_all", M.dense())
    numbers = F.array(*[F.when(F.isnan(x), F.lit("NaN")).otherwise(F.round(F.nanvl(x, F.lit(0.0)), 6).cast("decimal(20,6)").cast("string"))
                        for x in (F.get("_all", F.lit(i)) for i in range(len(MATRIX_COLS)))])
    flags = F.slice("_all", F.lit(len(MATRIX_COLS) + 1), F.col("features.size")).cast("array<int>").cast("array<string>")
    return out.select("obs_id", "is_test", "log_target", F.array_join(F.concat(numbers, flags), ",").alias("features"))


@query("feature_matrix_values", sql=_matrix_sql(f"{_first('obs_id', 'player_obs')} USING (obs_id)"))
def q_feature_matrix_values(spark, d):
    """G25 + G26 + G27: the rows of the matrix as text, value by value."""
    return _matrix_text(spark, d)


@query("feature_matrix_by_group", sql=_matrix_sql(f"{_first('player_id', 'player_obs')} USING (player_id)"))
def q_feature_matrix_by_group(spark, d):
    """G23 + G26 + G27: the split by player feeds scaler and encoder."""
    return _matrix_text(spark, d, group="player_id")
