"""The stateless puzzle enrichment gives the same rows on a stream as in batch."""

import tempfile

from scoutlab.operators.chess.features import chess_features
from scoutlab.streaming import stream_puzzle_features
from scoutlab.streaming.features import PUZZLE_SCHEMA

START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="scoutlab-stream-")
    rows = [("a", START, "e2e4 e7e5", 1500, 80, 90, 100, "opening short", "", ""),
            ("b", START, "e2e5", 2500, 80, 90, 100, "mate", "", "")]
    df = spark.createDataFrame(rows, PUZZLE_SCHEMA)
    df.write.mode("overwrite").parquet(f"{base}/in")
    q = stream_puzzle_features(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    q.awaitTermination(300)
    got = {r.PuzzleId: r for r in spark.read.parquet(f"{base}/out").collect()}
    exp = {r.PuzzleId: r for r in chess_features(df).collect()}
    assert set(got) == {"a", "b"}
    for k in got:
        assert got[k].branching_factor == exp[k].branching_factor
    assert got["a"].nivel_dificultad == "Intermedio" and got["b"].nivel_dificultad == "Maestro"
    assert got["a"].num_movimientos == 2
