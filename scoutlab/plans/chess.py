"""Chess plans (S7, C1-C17) on the puzzle stand-in (``part`` rows with a
position from the fixed list)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlab.operators import profile as G
from scoutlab.operators.chess import features as CF
from scoutlab.plans import standins as S
from scoutlab.plans.positions import positions_sql
from scoutlab.plans.positions_golden import golden_sql, replayed_sql
from scoutlab.plans.registry import query, r, rounded
from scoutlab.sources import io

WITH = S.sql_cte("puzzles") + ", " + positions_sql() + """,
m AS (SELECT p.PuzzleId, f.FEN, f.Moves FROM puzzles p JOIN fixture_positions f USING (position_no)),
b AS (SELECT PuzzleId, FEN, string_split(trim(FEN), ' ') AS parts, split_part(trim(FEN), ' ', 1) AS board FROM m),
e AS (SELECT PuzzleId, FEN, parts, board,
        replace(replace(replace(replace(replace(replace(replace(replace(board, '8', '........'), '7', '.......'),
          '6', '......'), '5', '.....'), '4', '....'), '3', '...'), '2', '..'), '1', '.') AS expanded FROM b),
v AS (SELECT PuzzleId, FEN, parts, replace(expanded, '/', '') AS flat,
        regexp_full_match(board, '([pnbrqkPNBRQK1-8]+/){7}[pnbrqkPNBRQK1-8]+')
        AND NOT regexp_matches(board, '[1-8]{2}')
        AND list_bool_and(list_transform(string_split(expanded, '/'), lambda x: length(x) = 8))
        AND len(parts) <= 6 AND coalesce(parts[2], 'w') IN ('w', 'b') AS ok FROM e),
cells AS (SELECT PuzzleId, CAST((7 - i // 8) * 8 + i % 8 AS INT) AS square, (7 - i // 8) AS rnk, i % 8 AS fil,
            substr(flat, i + 1, 1) AS piece FROM v, range(64) t(i) WHERE ok AND substr(flat, i + 1, 1) != '.'),
mass AS (SELECT *, CASE lower(piece) WHEN 'p' THEN 1 WHEN 'n' THEN 3 WHEN 'b' THEN 3 WHEN 'r' THEN 5
                     WHEN 'q' THEN 9 ELSE 0 END AS w, piece = upper(piece) AS is_white FROM cells)
"""


def muestra(spark, d):
    return S.puzzles_with_positions(spark, d)


@query("fen_lookup", sql=WITH + "SELECT PuzzleId, FEN FROM m WHERE PuzzleId = 'P7'")
def q_fen_lookup(spark, d):
    """Position by id; a missing id is an error."""
    positions = muestra(spark, d).select(F.col("puzzle_key").alias("id"), "PuzzleId", F.col("FEN").alias("fen"))
    found = io.fen_lookup(positions, 7)
    return found.select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("PuzzleId"), F.col("fen").alias("FEN"))


@query("fen_pieces", sql=WITH + "SELECT PuzzleId, square, piece FROM cells")
def q_fen_pieces(spark, d):
    """FEN -> one row per piece (square a1 = 0)."""
    return CF.fen_pieces(muestra(spark, d), "PuzzleId").select(
        "PuzzleId", F.col("square").cast("int").alias("square"), "piece")


@query("fen_state", sql=WITH + """
SELECT PuzzleId, parts[2] = 'w' AS white, parts[3] AS castling,
       CASE WHEN parts[4] = '-' THEN NULL ELSE CAST(ascii(substr(parts[4], 1, 1)) - 97
            + (CAST(substr(parts[4], 2, 1) AS INT) - 1) * 8 AS INT) END AS ep,
       CAST(parts[5] AS INT) AS halfmove, CAST(parts[6] AS INT) AS fullmove
FROM v WHERE ok""")
def q_fen_state(spark, d):
    """Side to move, castling field, en passant square, clocks."""
    p = CF.parse_fen(muestra(spark, d).select("PuzzleId", "FEN"))
    return p.filter("fen_ok").select("PuzzleId", "white", "castling", "ep", "halfmove", "fullmove")


def _weighed(spark, d):
    p = CF.parse_fen(muestra(spark, d).select("PuzzleId", "FEN")).filter("fen_ok")
    return CF.measured(p.drop("_geo"), keep=["PuzzleId"]).select(
        "PuzzleId", F.col("at_entropy").alias("spatial_entropy"), F.col("at_distance").alias("com_chebyshev_dist"))


@query("spatial_entropy", sql=WITH + f""",
q AS (SELECT PuzzleId, SUM(w) FILTER (WHERE fil < 4 AND rnk < 4) AS q0, SUM(w) FILTER (WHERE fil >= 4 AND rnk < 4) AS q1,
             SUM(w) FILTER (WHERE fil < 4 AND rnk >= 4) AS q2, SUM(w) FILTER (WHERE fil >= 4 AND rnk >= 4) AS q3,
             SUM(w) AS t FROM mass GROUP BY PuzzleId)
SELECT PuzzleId, {r('CASE WHEN t = 0 THEN 0.0 ELSE ' + ' + '.join(
    f'CASE WHEN coalesce(q{i}, 0) > 0 THEN -(q{i} / t) * ln(q{i} / t) ELSE 0 END' for i in range(4)) + ' END')}
    AS spatial_entropy
FROM q""")
def q_spatial_entropy(spark, d):
    """C9 on the position as written."""
    return _weighed(spark, d).select("PuzzleId", "spatial_entropy")


@query("com_chebyshev", sql=WITH + f""",
c AS (SELECT PuzzleId, SUM(w) FILTER (WHERE is_white) AS wm, SUM(w * fil) FILTER (WHERE is_white) AS wx,
             SUM(w * rnk) FILTER (WHERE is_white) AS wy, SUM(w) FILTER (WHERE NOT is_white) AS bm,
             SUM(w * fil) FILTER (WHERE NOT is_white) AS b_x, SUM(w * rnk) FILTER (WHERE NOT is_white) AS b_y
      FROM mass GROUP BY PuzzleId)
SELECT PuzzleId, {r('CASE WHEN coalesce(wm, 0) = 0 OR coalesce(bm, 0) = 0 THEN 0.0 ELSE '
                    'greatest(abs(wx / wm - b_x / bm), abs(wy / wm - b_y / bm)) END')} AS com_chebyshev_dist
FROM c""")
def q_com(spark, d):
    """C10 on the position as written."""
    return _weighed(spark, d).select("PuzzleId", "com_chebyshev_dist")


def _board(spark, d):
    return CF.board_features(muestra(spark, d).select("PuzzleId", "FEN"), keep=["PuzzleId"]).filter("fen_ok")


# What the rules give for the fixed positions (move by move, without this library).
GOLDEN = S.sql_cte("puzzles") + ", " + golden_sql() + "\n"
ON = "FROM puzzles p JOIN golden g USING (position_no)"


@query("attack_edges", sql=GOLDEN + f"SELECT PuzzleId, CAST(n_pieces AS INT) AS n_pieces, CAST(n_edges AS INT) AS n_edges {ON}")
def q_attack_edges(spark, d):
    """Pieces and attack edges onto occupied squares."""
    return _board(spark, d).select("PuzzleId", "n_pieces", "n_edges")


@query("graph_density", sql=GOLDEN + f"SELECT PuzzleId, {r('CASE WHEN n_pieces > 1 THEN n_edges / (n_pieces * (n_pieces - 1)) ELSE 0.0 END')} AS graph_density {ON}")
def q_graph_density(spark, d):
    """C7."""
    return _board(spark, d).select("PuzzleId", "graph_density")


@query("tension_components", sql=GOLDEN + f"SELECT PuzzleId, CAST(parts AS INT) AS tension_components {ON}")
def q_tension(spark, d):
    """Weakly connected components of the attack graph."""
    return _board(spark, d).select("PuzzleId", "tension_components")


@query("legal_moves", sql=GOLDEN + f"SELECT PuzzleId, moves {ON}")
def q_legal_moves(spark, d):
    """C11: legal moves of the side to move, as sorted UCI strings in one text."""
    b = CF.parse_fen(muestra(spark, d).select("PuzzleId", "FEN")).filter("fen_ok")
    b = CF.with_legal_moves(b, boards=False, keep=["PuzzleId"])
    squares = ", ".join(f"'{f}{r}'" for r in range(1, 9) for f in "abcdefgh")
    uci = f"sort_array(transform(legal, x -> concat(array({squares})[x.m.fr], array({squares})[x.m.to], coalesce(x.m.pr, ''))))"
    return b.select("PuzzleId", F.array_join(F.expr(uci), " ").alias("moves"))


@query("branching_factor", sql=GOLDEN + f"SELECT PuzzleId, CAST(n_moves AS INT) AS branching_factor {ON}")
def q_branching(spark, d):
    """C12."""
    return _board(spark, d).select("PuzzleId", "branching_factor")


@query("forcing_index", sql=GOLDEN + f"SELECT PuzzleId, {r('CASE WHEN n_moves > 0 THEN n_forcing / n_moves ELSE 0.0 END')} AS forcing_index {ON}")
def q_forcing(spark, d):
    """C13."""
    return _board(spark, d).select("PuzzleId", "forcing_index")


@query("in_check", sql=GOLDEN + f"SELECT PuzzleId, checked AS in_check {ON}")
def q_in_check(spark, d):
    """C14."""
    return _board(spark, d).select("PuzzleId", "in_check")


@query("apply_first_move", sql=GOLDEN + """
SELECT PuzzleId, board_after IS NOT NULL AS move_ok, COALESCE(board_after, '') AS board_after, castling AS a_castling,
       CAST(ep AS INT) AS a_ep, CAST(clock AS INT) AS a_halfmove FROM puzzles p LEFT JOIN golden g USING (position_no)""")
def q_apply_first_move(spark, d):
    """C3 + C16: the first move validated against the legal moves and
    applied (board after the move as a 64-letter string)."""
    b = CF.apply_first_move(CF.parse_fen(muestra(spark, d).select("PuzzleId", "FEN", "Moves")), keep=["PuzzleId"])
    return b.select("PuzzleId", "move_ok", F.concat_ws("", "a_bd").alias("board_after"),
                    "a_castling", "a_ep", "a_halfmove")


@query("replay_positions", sql=S.sql_cte("puzzles") + ", " + replayed_sql() + """
SELECT PuzzleId, CAST(step AS INT) AS step, move, flip, board FROM puzzles JOIN replayed USING (position_no)""")
def q_replay(spark, d):
    """C4 + C5: one board per step of the whole move list."""
    return CF.replay_positions(muestra(spark, d), "PuzzleId")


MEASURED_SQL = f"""SELECT p.*, f.FEN, f.Moves, CAST(COALESCE(a_moves, 0) AS INT) AS branching_factor,
  {r('CASE WHEN a_moves > 0 THEN a_forcing / a_moves ELSE 0.0 END')} AS forcing_index,
  {r('CASE WHEN a_pieces > 1 THEN a_edges / (a_pieces * (a_pieces - 1)) ELSE 0.0 END')} AS graph_density,
  CAST(COALESCE(a_parts, 0) AS INT) AS tension_components,
  {r('CAST(COALESCE(a_entropy, 0) AS DOUBLE)')} AS spatial_entropy, {r('CAST(COALESCE(a_distance, 0) AS DOUBLE)')} AS com_chebyshev_dist
FROM puzzles p JOIN fixture_positions f USING (position_no) LEFT JOIN golden g USING (position_no)"""
MEASURED = S.sql_cte("puzzles") + ", " + positions_sql() + ", " + golden_sql() + f", measured AS ({MEASURED_SQL})\n"


@query("chess_features", sql=MEASURED + """
SELECT PuzzleId, FEN, Moves, Rating, RatingDeviation, Popularity, NbPlays, Themes, branching_factor, forcing_index,
       graph_density, tension_components, spatial_entropy, com_chebyshev_dist FROM measured""")
def q_chess_features(spark, d):
    """C17 (+ J7, C15, C16): muestra -> muestra_procesada."""
    df = muestra(spark, d).select("PuzzleId", "FEN", "Moves", "Rating", "RatingDeviation", "Popularity",
                                  "NbPlays", "Themes")
    return CF.chess_features(df)


FEATURES = ["branching_factor", "forcing_index", "graph_density", "tension_components", "spatial_entropy", "com_chebyshev_dist"]


@query("describe_chess", sql=MEASURED + " UNION ALL ".join(f"""
SELECT '{c}' AS col_name, COUNT({c}) AS count, {r(f'AVG({c})')} AS mean, {r(f'STDDEV_SAMP({c})')} AS std, {r(f'MIN({c})::DOUBLE')} AS min,
  {r(f'quantile_cont({c}::DOUBLE, 0.25)')} AS q25, {r(f'quantile_cont({c}::DOUBLE, 0.5)')} AS q50,
  {r(f'quantile_cont({c}::DOUBLE, 0.75)')} AS q75, {r(f'MAX({c})::DOUBLE')} AS max FROM measured""" for c in FEATURES))
def q_describe_chess(spark, d):
    """G1 over the six features."""
    return G.describe(q_chess_features(spark, d), FEATURES)


@query("iqr_chess", sql=MEASURED + " UNION ALL ".join(f"""
SELECT '{c}' AS col_name, {r('q1')} AS q1, {r('q3')} AS q3, {r('q3 - q1')} AS iqr, {r('q1 - 1.5 * (q3 - q1)')} AS lower,
  {r('q3 + 1.5 * (q3 - q1)')} AS upper, (SELECT COUNT(*) FROM measured WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
  (SELECT ROUND(COUNT(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / COUNT(*), 2) FROM measured) AS pct_outliers
FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM measured)""" for c in FEATURES))
def q_iqr_chess(spark, d):
    """G3 over the six features (rounded to six decimals first, as their table is)."""
    return G.iqr_outliers(rounded(q_chess_features(spark, d)), FEATURES)


def _corr(a: str, b: str) -> str:
    return (f"CASE WHEN STDDEV_POP({a}) * STDDEV_POP({b}) = 0 THEN NULL ELSE COVAR_POP({a}, {b}) / (STDDEV_POP({a}) * STDDEV_POP({b})) END")


@query("corr_chess", sql=MEASURED + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(_corr(a, b) if a != b else f'CASE WHEN STDDEV_POP({a}) > 0 THEN 1.0 END', 5)} AS r FROM measured"
    for a in [*FEATURES, "Rating"] for b in [*FEATURES, "Rating"]))
def q_corr_chess(spark, d):
    """G11 over the six features and the rating (shown to five decimals: their table is
    rounded to six)."""
    out = G.corr_matrix(rounded(q_chess_features(spark, d)), [*FEATURES, "Rating"])
    return out.withColumn("r", F.round("r", 5))
