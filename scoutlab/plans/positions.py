"""Fixed chess positions for the puzzle stand-in.

Fixed values: the sixteen positions of the reference's position file plus
five well-known perft test positions, each with a move list whose first
move is applied by the feature pipeline; then four failure cases (illegal
first move, empty move list, a first move that ends the game, a FEN with
seven ranks).  ``part`` rows pick one by ``p_partkey % 25``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSITIONS = [
    (0, "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", "e2e4 e7e5 g1f3"),
    (1, "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq e3 0 1", "e7e5 g1f3"),
    (2, "rnbqkbnr/pp1ppppp/8/2p5/4P3/8/PPPP1PPP/RNBQKBNR w KQkq c6 0 2", "f1c4 b8c6"),
    (3, "rnbqkbnr/pp1ppppp/8/2p5/4P3/5N2/PPPP1PPP/RNBQKB1R b KQkq - 1 2", "d8a5 c2c3"),
    (4, "4K3/2k1P3/8/8/8/8/5r2/6R1 w - - 0 1", "g1g7 c7d6"),
    (5, "8/8/8/4p1K1/2k1P3/8/8/8 b - - 0 1", "c4d4 g5f5"),
    (6, "4k2r/6r1/8/8/8/8/3R4/R3K3 w Qk - 0 1", "e1c1 h8h1"),
    (7, "r1bk3r/p2pBpNp/n4n2/1p1NP2P/6P1/3P4/P1P1K3/q5b1 w - - 0 1", "e7f6 a8b8"),
    (8, "1q6/2b2ppb/4p1k1/7p/2Np1p1P/3P1Q2/6PK/8 w - - 0 1", "c4d6 c7d6"),
    (9, "8/p1p3pp/5ppk/6q1/5PPK/6P1/P1P3PP/8 w - - 0 1", "f4g5 h6g5"),
    (10, "3Rbk1K/qqqqq1NQ/6Qq/6QQ/6Qq/2b3QQ/1B4Qq/q5R1 b - - 0 1", "b7g2 h2g2"),
    (11, "r3kn1Q/p1p1bpp1/2P3bB/4R2p/8/2P1p2r/4P3/3KR3 w q - 0 1", "h8g8 f8g6"),
    (12, "5k2/8/8/8/8/5q2/7Q/6QK w - - 0 1", "h2g2 f3g2"),
    (13, "5k2/1Q6/8/8/7q/8/8/6QK w - - 0 1", "g1h2 h4h2"),
    (14, "8/8/8/8/3K2N1/7R/4p1p1/4qkqR w - - 0 1", "h3e3 e1e2"),
    (15, "rnb1kbnr/pppp1ppp/8/4p3/6Pq/5P2/PPPPP2P/RNBQKBNR w - - 0 1", "e1e2"),
    (16, "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", "e1g1 b4c3"),
    (17, "8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", "b4f4 h4g3"),
    (18, "r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1", "c4c5 b6c5"),
    (19, "rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", "d7c8q e7c5"),
    (20, "r4rk1/1pp1qppp/p1np1n2/2b1p1B1/2B1P1b1/P1NP1N2/1PP1QPPP/R4RK1 w - - 0 10", "c3d5 f6d5"),
    (21, "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", "e2e5 e7e5"),
    (22, "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", ""),
    (23, "rnbqkbnr/pppp1ppp/8/4p3/6P1/5P2/PPPPP2P/RNBQKBNR b KQkq - 0 2", "d8h4"),
    (24, "rnbqkbnr/pppppppp/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", "e2e4"),
]
N_POSITIONS = len(POSITIONS)


def positions_df(spark: SparkSession) -> DataFrame:
    """The 25 fixed rows (a bounded table, safe to broadcast)."""
    return spark.createDataFrame(POSITIONS, "position_no INT, FEN STRING, Moves STRING")


def positions_sql() -> str:
    rows = ", ".join(f"({i}, '{f}', '{m}')" for i, f, m in POSITIONS)
    return f"fixture_positions(position_no, FEN, Moves) AS (VALUES {rows})"
