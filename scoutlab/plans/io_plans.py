"""Source/sink plans (S1-S3, S5, S6, S8, S9): round trips through files in
the session's shared checkpoint folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from scoutlab.functions.predicates import numeric
from scoutlab.plans import standins as S
from scoutlab.plans.positions import positions_sql
from scoutlab.plans.registry import query
from scoutlab.session import checkpoint_dir
from scoutlab.sources import io

GAMES_SCHEMA = T.StructType([T.StructField("game_id", T.LongType()), T.StructField("season", T.IntegerType())])
CLUB_GAMES_SCHEMA = T.StructType([
    T.StructField("game_id", T.LongType()), T.StructField("club_id", T.LongType()),
    T.StructField("own_goals", T.IntegerType()), T.StructField("opponent_goals", T.IntegerType()),
    T.StructField("is_win", T.IntegerType())])


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}"


@query("roundtrip_csv", sql=S.sql_cte("games") + "SELECT game_id, season FROM games")
def q_roundtrip_csv(spark, d):
    """S6 + S2: write a header CSV folder, read it back with a schema."""
    path = _scratch(spark)
    io.write_csv(S.games(spark, d), path)
    return io.read_csv(spark, path, GAMES_SCHEMA)


@query("scan_gzip_csv", sql=S.sql_cte("club_games") + "SELECT * FROM club_games")
def q_scan_gzip(spark, d):
    """Gzip CSV read with an explicit schema, spread after the
    (unsplittable) per-file read."""
    path = _scratch(spark)
    S.club_games(spark, d).write.option("header", True).option("compression", "gzip").csv(path)
    return io.read_csv(spark, path, CLUB_GAMES_SCHEMA,
                       min_partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("roundtrip_table", sql=S.sql_cte("player_obs") + "SELECT * FROM player_obs")
def q_roundtrip_table(spark, d):
    """S5 + S4: replace a Parquet table as a whole and scan it."""
    path = _scratch(spark)
    io.write_table(S.player_obs(spark, d), path)
    io.write_table(S.player_obs(spark, d), path)  # replace, not append
    return spark.read.parquet(path)


@query("load_raw", sql=S.sql_cte("games", "club_games") + """
SELECT 'games' AS "table", COUNT(*) AS n_rows, CAST(SUM(game_id) AS BIGINT) AS sum_id FROM games
UNION ALL SELECT 'club_games', COUNT(*), CAST(SUM(game_id) AS BIGINT) FROM club_games""")
def q_load_raw(spark, d):
    """Two raw CSVs loaded to two named tables in one step (rows and sum of
    the game ids of either table)."""
    base = _scratch(spark)
    io.write_csv(S.games(spark, d), f"{base}/src/games")
    io.write_csv(S.club_games(spark, d), f"{base}/src/club_games")
    out = io.load_raw(spark, {"games": f"{base}/src/games", "club_games": f"{base}/src/club_games"},
                      f"{base}/tables", {"games": GAMES_SCHEMA, "club_games": CLUB_GAMES_SCHEMA})
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("game_id").alias("sum_id"))
             .select(F.lit(n).alias("table"), "n_rows", "sum_id") for n, p in sorted(out.items())]
    return parts[0].unionByName(parts[1])


@query("schema_catalog", sql="""
SELECT * FROM (VALUES ('club_games', 5, 0, 'game_id'), ('club_games', 5, 1, 'club_id'), ('club_games', 5, 2, 'own_goals'),
  ('club_games', 5, 3, 'opponent_goals'), ('club_games', 5, 4, 'is_win'), ('games', 2, 0, 'game_id'), ('games', 2, 1, 'season'))
  t(folder, n_columns, position, column_name)""")
def q_schema_catalog(spark, d):
    """S3: header-only catalogue of the gzip CSVs below a folder, part files written in
    parallel; files of one folder that agree are one entry."""
    base = _scratch(spark)
    for name, df in (("games", S.games(spark, d)), ("club_games", S.club_games(spark, d))):
        df.write.option("header", True).option("compression", "gzip").csv(f"{base}/{name}")
    found = io.schema_catalog(spark, base).filter("error IS NULL")
    return found.select("folder", "n_columns", "position", "column_name").distinct()


_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


@query("table_structure", sql=S.sql_cte("player_obs") + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS name, CASE typeof(ANY_VALUE({c})) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items())
    + f" END AS type, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM player_obs" for i, (c, _) in enumerate(S.PLAYER_OBS)))
def q_table_structure(spark, d):
    """(position, name, type) of the player table with the nulls of every column
    (the approximate distinct counts have no counterpart in the oracle)."""
    return io.table_structure(S.player_obs(spark, d)).drop("n_distinct")


@query("table_preview", sql=S.sql_cte("player_obs") + "SELECT * FROM player_obs ORDER BY obs_id LIMIT 3")
def q_table_preview(spark, d):
    """The first three rows by key."""
    return io.table_preview(S.player_obs(spark, d), 3, "obs_id")


# Numbers as text, some of them not numbers, by rules of the key.
_DIRTY = ("CASE WHEN obs_id % 11 = 0 THEN 'n/a' WHEN obs_id % 17 = 0 THEN '' WHEN obs_id % 19 = 0 THEN '12,5' "
          "WHEN obs_id % 23 = 0 THEN '1.5e2' WHEN obs_id % 29 = 0 THEN ' 170.5 ' WHEN obs_id % 31 = 0 THEN NULL "
          "ELSE CAST(165 + obs_id % 35 AS STRING) END")


@query("coerce_numeric", sql=S.sql_cte("player_obs") + f"""
SELECT obs_id, TRY_CAST(t AS DOUBLE) AS value, t IS NOT NULL AND TRY_CAST(t AS DOUBLE) IS NULL AS bad
FROM (SELECT obs_id, {_DIRTY} AS t FROM player_obs)""")
def q_coerce_numeric(spark, d):
    """Numbers held as text; what is no number is null and marked."""
    df = S.player_obs(spark, d).select("obs_id").withColumn("t", F.expr(_DIRTY))
    return df.select("obs_id", numeric("t").alias("value"), (F.col("t").isNotNull() & numeric("t").isNull()).alias("bad"))


DIRTY_SCHEMA = T.StructType([T.StructField("obs_id", T.LongType()), T.StructField("altura_cm", T.DoubleType()),
                             T.StructField("goles_12m", T.IntegerType())])


@query("read_dirty_csv", sql=S.sql_cte("player_obs") + """
SELECT obs_id, CASE WHEN obs_id % 11 = 0 THEN NULL ELSE CAST(165 + obs_id % 35 AS DOUBLE) END AS altura_cm,
       CASE WHEN obs_id % 13 = 0 THEN NULL ELSE CAST(obs_id % 17 AS INT) END AS goles_12m,
       CASE WHEN obs_id % 11 = 0 OR obs_id % 13 = 0 THEN CAST(obs_id AS VARCHAR) || ',' ||
         CASE WHEN obs_id % 11 = 0 THEN 'alto' ELSE CAST(165 + obs_id % 35 AS VARCHAR) END || ',' ||
         CASE WHEN obs_id % 13 = 0 THEN 'dos' ELSE CAST(obs_id % 17 AS VARCHAR) END END AS rescued
FROM player_obs""")
def q_read_dirty_csv(spark, d):
    """S1/S2 + P6: a CSV with planted words in number columns, read with its types; the
    bad fields are null and their line is kept."""
    path = _scratch(spark)
    S.player_obs(spark, d).selectExpr(
        "obs_id", "CASE WHEN obs_id % 11 = 0 THEN 'alto' ELSE CAST(165 + obs_id % 35 AS STRING) END AS altura_cm",
        "CASE WHEN obs_id % 13 = 0 THEN 'dos' ELSE CAST(obs_id % 17 AS STRING) END AS goles_12m",
    ).write.option("header", True).csv(path)
    df = io.read_csv_permissive(spark, path, DIRTY_SCHEMA)
    return df.withColumnRenamed(io.RESCUED, "rescued")


@query("positions_json", sql=S.sql_cte("puzzles") + ", " + positions_sql() + """
SELECT w.id, f.FEN AS fen, CASE WHEN p.puzzle_key IS NULL THEN 'position ' || CAST(w.id AS VARCHAR) || ' not found' END AS error
FROM (SELECT puzzle_key * 3 AS id FROM puzzles) w LEFT JOIN puzzles p ON p.puzzle_key = w.id
LEFT JOIN fixture_positions f ON f.position_no = p.position_no""")
def q_positions_json(spark, d):
    """Positions written as JSON records and read back, looked up by many ids; an id
    without a position keeps its row and says so."""
    path = _scratch(spark)
    puzzles = S.puzzles_with_positions(spark, d).select(F.col("puzzle_key").alias("id"), F.col("FEN").alias("fen"))
    puzzles.write.json(path)
    wanted = puzzles.select((F.col("id") * 3).alias("id"))
    return io.fen_lookups(io.read_positions_json(spark, path, multi_line=False), wanted)
