"""Stand-in tables: the reference's football and puzzle tables derived from
the driver's TPC-H-like test tables.

Each stand-in is a set of column expressions written in the SQL subset that
Spark SQL and DuckDB both accept, so the Spark plan (``selectExpr``) and the
DuckDB oracle (a CTE) start from identical inputs.  Null injection is
deterministic (key modulo), because the test tables contain no nulls.
Everything is a projection of a scan or of an equi-join on keys, so the
derived tables grow with the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlab.sources.io import table

AS_OF_YEAR = 2025

# --- football: raw files -------------------------------------------------

PLAYERS_RAW = [
    ("player_id", "c_custkey"),
    ("current_club_id", "CAST(c_nationkey AS BIGINT)"),
    ("date_of_birth",
     "CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE "
     "CAST(1975 + c_custkey % 25 AS STRING) || '-' || "
     "lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || '-' || "
     "lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') END"),
    ("height_in_cm", "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(165 + c_custkey % 35 AS DOUBLE) END"),
    ("market_value_in_eur", "c_acctbal * 1000.0"),
]

CLUBS = [
    ("club_id", "CAST(n_nationkey AS BIGINT)"),
    ("name", "n_name"),
    ("domestic_competition_id", "CAST(n_regionkey AS STRING)"),
    ("stadium_seats", "CAST(20000 + n_nationkey * 1500 AS INT)"),
    ("foreigners_percentage", "CAST(n_nationkey AS DOUBLE) * 1.5"),
    ("national_team_players", "CAST(n_nationkey % 7 AS INT)"),
]

COMPETITIONS = [
    ("competition_id", "CAST(r_regionkey AS STRING)"),
    ("name", "r_name"),
    ("country_name", "lower(r_name)"),
]

GAMES = [
    ("game_id", "o_orderkey"),
    ("season", "CAST(year(o_orderdate) AS INT)"),
]

CLUB_GAMES = [  # orders JOIN customer ON o_custkey = c_custkey
    ("game_id", "o_orderkey"),
    ("club_id", "CAST(c_nationkey AS BIGINT)"),
    ("own_goals", "CAST(o_orderkey % 5 AS INT)"),
    ("opponent_goals", "CAST(o_orderkey % 4 AS INT)"),
    ("is_win", "CASE WHEN o_orderkey % 5 > o_orderkey % 4 THEN 1 ELSE 0 END"),
]

APPEARANCES = [  # lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer
    ("game_id", "l_orderkey"),
    ("player_club_id", "CAST(c_nationkey AS BIGINT)"),
    ("yellow_cards", "CAST(l_linenumber % 3 AS INT)"),
    ("red_cards", "CASE WHEN l_returnflag = 'R' AND l_linenumber % 4 = 0 THEN 1 ELSE 0 END"),
    ("assists", "CAST(l_linenumber % 2 AS INT)"),
    ("minutes_played", "CASE WHEN c_nationkey % 6 = 0 THEN 0 ELSE 90 - l_linenumber * 5 END"),
]

# --- football: longitudinal player table (jugadores) ---------------------
# orders JOIN customer ON o_custkey = c_custkey
#        JOIN nation ON c_nationkey = n_nationkey
#        JOIN region ON n_regionkey = r_regionkey

PLAYER_OBS = [
    ("obs_id", "o_orderkey"),
    ("id_observacion", "c_name || '_' || CAST(year(o_orderdate) AS STRING)"),
    ("player_id", "o_custkey"),
    ("fecha_valoracion", "CAST(CAST(o_orderdate AS DATE) AS STRING)"),
    ("valor_mercado_eur_TARGET", "o_totalprice * 100.0"),
    ("edad_al_momento",
     "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE "
     "CAST(17 + o_custkey % 20 + (year(o_orderdate) - 1995) AS DOUBLE) END"),
    ("mes_de_nacimiento", "CAST(1 + o_custkey % 12 AS DOUBLE)"),
    ("altura_cm", "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(165 + o_custkey % 35 AS DOUBLE) END"),
    ("dias_para_fin_contrato",
     "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST((o_orderkey * 37) % 1800 AS DOUBLE) END"),
    ("minutos_jugados_12m", "CAST((o_orderkey % 41) * 75 AS DOUBLE)"),
    ("partidos_jugados_12m", "CAST(o_orderkey % 41 AS DOUBLE)"),
    ("goles_12m", "CAST(o_orderkey % 17 AS DOUBLE)"),
    ("asistencias_12m", "CAST(o_orderkey % 13 AS DOUBLE)"),
    ("tarjetas_amarillas_12m", "CAST(o_orderkey % 9 AS DOUBLE)"),
    ("tarjetas_rojas_12m", "CAST(o_orderkey % 3 AS DOUBLE)"),
    ("participacion_goles_p90",
     "CASE WHEN o_orderkey % 41 = 0 THEN 0.0 ELSE "
     "CAST(o_orderkey % 17 + o_orderkey % 13 AS DOUBLE) * 90.0 / CAST((o_orderkey % 41) * 75 AS DOUBLE) END"),
    ("partidos_seleccion_12m", "CAST(o_custkey % 11 AS DOUBLE)"),
    ("convocatorias_historicas_seleccion", "CAST(o_custkey % 40 AS DOUBLE)"),
    ("valor_maximo_historico_previo", "o_totalprice * 120.0"),
    ("posicion_principal", "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END"),
    ("pie_habil",
     "CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'right' "
     "WHEN o_orderstatus = 'O' THEN 'left' ELSE 'both' END"),
    ("liga_actual", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE n_name END"),
    ("nacionalidad", "CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE r_name END"),
]

PLAYER_NUMERIC = [c for c, _ in PLAYER_OBS[4:19]]
PLAYER_TEXT = ["posicion_principal", "pie_habil", "liga_actual", "nacionalidad"]

# --- chess puzzles (muestra) from part ------------------------------------
# Positions come from the fixed fixture list (25 rows, broadcast), chosen by
# key; puzzle attributes are integer rules of p_partkey.

PUZZLES = [
    ("PuzzleId", "'P' || CAST(p_partkey AS STRING)"),
    ("puzzle_key", "p_partkey"),
    ("Rating", "CAST(600 + (p_partkey * 37) % 2400 AS INT)"),
    ("RatingDeviation", "CAST(75 + p_partkey % 20 AS INT)"),
    ("Popularity", "p_size"),
    ("NbPlays", "CAST((p_partkey * 131) % 5000 AS INT)"),
    ("Themes", "p_type || ' ' || p_name"),
    ("position_no", "CAST(p_partkey % 25 AS INT)"),
]


def _select(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols])


def sql_select(cols: list[tuple[str, str]]) -> str:
    """The same projection as SQL text (for the DuckDB oracle)."""
    return ", ".join(f"{expr} AS {name}" for name, expr in cols)


def players_raw(spark: SparkSession, d: str) -> DataFrame:
    return _select(table(spark, d, "customer"), PLAYERS_RAW)


def clubs(spark: SparkSession, d: str) -> DataFrame:
    return _select(table(spark, d, "nation"), CLUBS)


def competitions(spark: SparkSession, d: str) -> DataFrame:
    return _select(table(spark, d, "region"), COMPETITIONS)


def games(spark: SparkSession, d: str) -> DataFrame:
    return _select(table(spark, d, "orders"), GAMES)


def club_games(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return _select(o.join(c, o.o_custkey == c.c_custkey), CLUB_GAMES)


def appearances(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    return _select(j, APPEARANCES)


def player_obs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
         .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
    return _select(j, PLAYER_OBS)


def puzzles(spark: SparkSession, d: str) -> DataFrame:
    return _select(table(spark, d, "part"), PUZZLES)


def puzzles_with_positions(spark: SparkSession, d: str) -> DataFrame:
    """``muestra``: puzzles with FEN and Moves from the fixed position list
    (25 rows: a bounded broadcast side).  The rows are dealt out first: a position
    costs far more than its row, and a small file is read by one task."""
    from scoutlab.plans.positions import positions_df
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return puzzles(spark, d).repartition(tasks).join(F.broadcast(positions_df(spark)), "position_no")


# SQL FROM clauses for the oracle side.
SQL_FROM = {
    "players_raw": "customer",
    "clubs": "nation",
    "competitions": "region",
    "games": "orders",
    "club_games": "orders JOIN customer ON o_custkey = c_custkey",
    "appearances": ("lineitem JOIN orders ON l_orderkey = o_orderkey "
                    "JOIN customer ON o_custkey = c_custkey"),
    "player_obs": ("orders JOIN customer ON o_custkey = c_custkey "
                   "JOIN nation ON c_nationkey = n_nationkey "
                   "JOIN region ON n_regionkey = r_regionkey"),
    "puzzles": "part",
}
SQL_COLS = {
    "players_raw": PLAYERS_RAW, "clubs": CLUBS, "competitions": COMPETITIONS,
    "games": GAMES, "club_games": CLUB_GAMES, "appearances": APPEARANCES,
    "player_obs": PLAYER_OBS, "puzzles": PUZZLES,
}


def sql_cte(*names: str) -> str:
    """``WITH name AS (SELECT ... FROM ...), ...`` for the oracle."""
    parts = [f"{n} AS (SELECT {sql_select(SQL_COLS[n])} FROM {SQL_FROM[n]})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
