"""Golden values for the chess operators (FIXTURES.md section 3)."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

import chess_brute as brute
from conftest import SF_SMALL
from scoutlab.operators.chess import features as CF

HERE = os.path.dirname(os.path.abspath(__file__))

# id: (moves, forcing, V, E, density, components, entropy, distance)
GOLDEN = {
    1: (20, 0.0, 32, 40, 0.040323, 2, 1.359426, 6.589744),
    2: (20, 0.0, 32, 36, 0.036290, 4, 1.359426, 6.538462),
    3: (30, 0.0, 32, 35, 0.035282, 5, 1.359426, 6.487179),
    4: (22, 0.0, 32, 40, 0.040323, 4, 1.359426, 6.333333),
    5: (14, 0.071429, 5, 1, 0.050000, 4, 0.304636, 0.666667),
    6: (7, 0.0, 4, 0, 0.0, 4, 0.693147, 1.0),
    7: (29, 0.103448, 6, 3, 0.100000, 3, 0.693147, 6.0),
    8: (28, 0.821429, 23, 27, 0.053360, 4, 1.273877, 1.566667),
    9: (28, 0.214286, 16, 17, 0.070833, 3, 1.325010, 3.8),
    10: (2, 0.5, 16, 21, 0.087500, 6, 1.083582, 2.952381),
    11: (104, 0.269231, 25, 102, 0.170000, 1, 1.284143, 2.552116),
    12: (24, 0.291667, 20, 25, 0.065789, 5, 1.029903, 1.12),
    13: (2, 0.0, 5, 8, 0.400000, 1, 0.0, 1.5),
    14: (2, 0.0, 5, 4, 0.200000, 2, 0.636514, 3.5),
    15: (9, 0.222222, 9, 16, 0.222222, 2, 0.0, 1.769231),
    16: (0, 0.0, 32, 36, 0.036290, 4, 1.359426, 5.538462),
    17: (48, 0.166667, 32, 62, 0.062500, 2, 1.357286, 4.384615),
    18: (14, 0.142857, 10, 8, 0.088889, 4, 1.354710, 3.625),
    19: (6, 0.0, 31, 54, 0.058065, 1, 1.301109, 3.276653),
    20: (44, 0.136364, 28, 38, 0.050265, 2, 1.321565, 5.621622),
    21: (46, 0.086957, 32, 62, 0.062500, 1, 1.359426, 4.230769),
}


@pytest.fixture(scope="module")
def board_rows(spark):
    pos = json.load(open(os.path.join(HERE, "fixtures", "positions.json")))
    df = spark.createDataFrame([(p["id"], p["fen"]) for p in pos], "id INT, FEN STRING")
    return {r.id: r for r in CF.board_features(df, keep=["id"]).collect()}


@pytest.mark.parametrize("pid", sorted(GOLDEN))
def test_board_golden(board_rows, pid):
    r = board_rows[pid]
    moves, forcing, v, e, dens, comp, ent, dist = GOLDEN[pid]
    assert r.fen_ok
    assert r.branching_factor == moves
    assert r.forcing_index == pytest.approx(forcing, abs=1e-6)
    assert (r.n_pieces, r.n_edges, r.tension_components) == (v, e, comp)
    assert r.graph_density == pytest.approx(dens, abs=1e-6)
    assert r.spatial_entropy == pytest.approx(ent, abs=1e-6)
    assert r.com_chebyshev_dist == pytest.approx(dist, abs=1e-6)
    assert 0.0 <= r.spatial_entropy <= math.log(4) + 1e-12
    assert 0.0 <= r.forcing_index <= 1.0


START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
KIWI = "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1"
EMPTY = (0, 0.0, 0.0, 0, 0.0, 0.0)


@pytest.fixture(scope="module")
def pipeline_rows(spark):
    rows = [
        (1, START, "e2e4 e7e5"),
        (2, KIWI, "e1g1 b4c3"),
        (3, START, "e2e5"),                       # illegal first move
        (4, START, ""),                           # empty move list
        (5, "rnbqkbnr/pppppppp/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", "e2e4"),  # 7 ranks
        (6, "rnbqkbnr/pppp1ppp/8/4p3/6P1/5P2/PPPPP2P/RNBQKBNR b KQkq - 0 2", "d8h4"),  # mate
        (7, START, None),
    ]
    df = spark.createDataFrame(rows, "id INT, FEN STRING, Moves STRING")
    return {r.id: r for r in CF.chess_features(df).collect()}


def _feats(r):
    return (r.branching_factor, r.forcing_index, r.graph_density, r.tension_components,
            r.spatial_entropy, r.com_chebyshev_dist)


def test_after_first_move_start(pipeline_rows):
    got = _feats(pipeline_rows[1])
    assert got[0] == 20 and got[3] == 4
    assert got[1] == pytest.approx(0.0) and got[2] == pytest.approx(0.036290, abs=1e-6)
    assert got[4] == pytest.approx(1.359426, abs=1e-6) and got[5] == pytest.approx(6.538462, abs=1e-6)


def test_after_first_move_castling(pipeline_rows):
    got = _feats(pipeline_rows[2])
    assert got[0] == 43 and got[3] == 2
    assert got[1] == pytest.approx(0.162791, abs=1e-6)
    assert got[2] == pytest.approx(0.064516, abs=1e-6)
    assert got[4] == pytest.approx(1.357286, abs=1e-6) and got[5] == pytest.approx(4.384615, abs=1e-6)


@pytest.mark.parametrize("pid", [3, 4, 5, 6, 7])
def test_empty_feature_cases(pipeline_rows, pid):
    assert _feats(pipeline_rows[pid]) == EMPTY


def test_row_count_kept(spark, pipeline_rows):
    assert len(pipeline_rows) == 7


def test_fen_pieces_and_replay(spark):
    df = spark.createDataFrame([(1, START, "e2e4 e7e5 g1f3")], "id INT, FEN STRING, Moves STRING")
    pieces = CF.fen_pieces(df, "id").collect()
    assert len(pieces) == 32
    assert {(r.square, r.piece) for r in pieces} >= {(0, "R"), (4, "K"), (60, "k"), (63, "r")}
    steps = CF.replay_positions(df, "id").orderBy("step").collect()
    assert [s.step for s in steps] == [0, 1, 2, 3]
    assert steps[0].flip is True
    assert steps[3].board[21] == "N" and steps[3].board[6] == "."  # g1 knight now on f3


def test_promotion_and_en_passant(spark):
    rows = [(1, "4k3/P7/8/8/8/8/8/4K3 w - - 0 1", "a7a8q"),
            (2, "4k3/8/8/3pP3/8/8/8/4K3 w - d6 0 1", "e5d6")]
    df = spark.createDataFrame(rows, "id INT, FEN STRING, Moves STRING")
    b = CF.apply_first_move(CF.parse_fen(df))
    got = {r.id: r for r in b.select("id", "move_ok", "a_bd").collect()}
    assert got[1].move_ok and got[1].a_bd[56] == "Q"
    assert got[2].move_ok and got[2].a_bd[43] == "P" and got[2].a_bd[35] == "."


START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"


REPLAYS = [
    ("e2e4 xxxx g1f3", ["e2e4"]), ("e2e5 e7e5", []), ("e7e8", []), (None, []), ("", []), ("  e2e4   e7e5 ", ["e2e4", "e7e5"]),
    ("e2e4 e2e4", ["e2e4"]), ("e2e4 d7d5 e4d5 d8d5 e1e2 d5e4", ["e2e4", "d7d5", "e4d5", "d8d5", "e1e2", "d5e4"]),
    ("e2e4 e7e5 g1f3 g8f6 f1c4 f8c5 e1g1 e8g8", ["e2e4", "e7e5", "g1f3", "g8f6", "f1c4", "f8c5", "e1g1", "e8g8"]),
    ("e2e4 a7a6 e4e5 d7d5 e5d6", ["e2e4", "a7a6", "e4e5", "d7d5", "e5d6"]),
    ("e2e4 e7e5 e1e2 a7a6 e2e1 a6a5 g1f3 a5a4 f1c4 b7b6 e1g1",  # a king that moved may not castle
     ["e2e4", "e7e5", "e1e2", "a7a6", "e2e1", "a6a5", "g1f3", "a5a4", "f1c4", "b7b6"]),
]


def test_replay_stops_before_the_first_bad_move(spark):
    df = spark.createDataFrame([(i, START, m) for i, (m, _) in enumerate(REPLAYS)], "id int, FEN string, Moves string")
    rows = CF.replay_positions(df, "id").collect()
    for i, (_, played) in enumerate(REPLAYS):
        steps = sorted((r for r in rows if r.id == i), key=lambda r: r.step)
        assert [(r.step, r.move) for r in steps] == list(enumerate([None, *played]))
        assert steps[0].board == "RNBQKBNR" + "P" * 8 + "." * 32 + "p" * 8 + "rnbqkbnr"
    last = next(r for r in rows if r.id == 9 and r.step == 5)
    assert last.board[35] == "." and last.board[43] == "P"  # the pawn taken in passing is gone


PERFT = {START: 400, KIWI: 2039, "8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1": 191,
         "r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1": 264,
         "rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8": 1486,
         "r4rk1/1pp1qppp/p1np1n2/2b1p1B1/2B1P1b1/P1NP1N2/1PP1QPPP/R4RK1 w - - 0 10": 2079}
SHARP = [*PERFT, "8/8/3p4/KPp4r/1R3p1k/8/4P1P1/8 w - c6 0 1", "4k3/8/8/K2pP2r/8/8/8/8 w - d6 0 1", "3rk3/8/8/3pP3/8/8/8/3K4 w - d6 0 1",
         "r3k2r/8/8/8/8/8/8/R3K2R w KQkq - 0 1", "r3k2r/8/8/8/8/8/8/R3K2R b KQkq - 0 1", "n1n5/PPPk4/8/8/8/8/4Kppp/5N1N b - - 0 1",
         "8/P1k5/8/8/8/8/p1K5/8 w - - 0 1", "4k3/4P3/4K3/8/8/8/8/8 w - - 0 1", "k7/1P6/2K5/8/8/8/8/8 w - - 0 1"]


def test_second_ply_counts_of_known_positions(spark):
    """Moves after every first move: the masks' counts add up to the published numbers."""
    rows = [(i, fen, brute.uci(m)) for i, fen in enumerate(PERFT) for m in brute.legal(brute.parse(fen))]
    df = spark.createDataFrame(rows, "id int, FEN string, Moves string")
    after = CF.apply_first_move(CF.parse_fen(df)).filter("move_ok").select("id", "a_bd", "a_white", "a_castling", "a_ep")
    after = CF.measured(after, ("a_bd", "a_white", "a_castling", "a_ep"))
    got = after.groupBy("id").agg({"at_moves": "sum"}).collect()
    assert {r.id: r[1] for r in got} == dict(enumerate(PERFT.values()))


@pytest.fixture(scope="module")
def played():
    return brute.positions(SHARP, 160, 50, 7)


def test_measures_match_plain_rules_on_random_games(spark, played):
    df = spark.createDataFrame([(i, brute.to_fen(s)) for i, s in enumerate(played)], "id int, FEN string")
    got = {r.id: r for r in CF.board_features(df, keep=["id"]).collect()}
    listed = {r.id: len(r.legal) for r in CF.with_legal_moves(CF.parse_fen(df)).collect()}
    for i, state in enumerate(played):
        moves = brute.legal(state)
        n, e, c = brute.graph(state[0])
        r = got[i]
        want = (len(moves), brute.forcing(state, moves) / len(moves) if moves else 0.0, n, e, c, brute.checked(state[0], state[1]))
        assert (r.branching_factor, r.forcing_index, r.n_pieces, r.n_edges, r.tension_components, r.in_check) == want, brute.to_fen(state)
        assert listed[i] == len(moves)


def test_positions_that_play_cannot_give(spark):
    """The side not to move is in check: counted move by move."""
    fens = ["4k3/8/8/8/8/8/4R3/4K3 w - - 0 1", "3qk3/8/8/8/7B/8/4Q3/4K3 w - - 0 1", "4k3/3P4/8/8/8/8/8/4K3 w - - 0 1"]
    df = spark.createDataFrame(list(enumerate(fens)), "id int, FEN string")
    for r in CF.board_features(df, keep=["id"]).collect():
        state = brute.parse(fens[r.id])
        moves = brute.legal(state)
        assert (r.branching_factor, r.forcing_index) == (len(moves), brute.forcing(state, moves) / len(moves))


def test_moves_are_legal_exactly_if_the_rules_allow_them(spark, played):
    import random
    rng = random.Random(3)
    rows, want = [], {}
    for state in played[:120]:
        moves = {brute.uci(m): m for m in brute.legal(state)}
        asked = set(rng.sample(sorted(moves), min(4, len(moves))))
        for m in rng.sample(sorted(moves), min(3, len(moves))):
            asked |= {m[:4], m[:4] + "q", m[2:4] + m[:2], m[:2] + rng.choice("abcdefgh") + rng.choice("12345678")}
        asked |= {rng.choice("abcdefgh") + rng.choice("12345678") + rng.choice("abcdefgh") + rng.choice("12345678") for _ in range(6)}
        for m in sorted(asked):
            rows.append((len(rows), brute.to_fen(state), m))
            want[len(want)] = brute.to_fen(brute.play(state, moves[m])).split()[:4] if m in moves else None
    df = spark.createDataFrame(rows, "id int, FEN string, Moves string")
    seen = set()
    for r in CF.apply_first_move(CF.parse_fen(df)).select("id", "move_ok", "a_bd", "a_white", "a_castling", "a_ep").collect():
        assert r.move_ok == (want[r.id] is not None), rows[r.id]
        if r.move_ok:
            got = brute.to_fen((r.a_bd, r.a_white, r.a_castling, r.a_ep, 0)).split()[:4]
            assert got == want[r.id], rows[r.id]
        seen.add(r.move_ok)
    assert seen == {True, False}


def test_the_75_move_rule_and_dead_positions_are_empty(spark):
    rows = [(1, "4k3/8/8/8/8/8/4R3/4K2r w - - 149 90", "e1d2"), (2, "4k3/8/8/8/8/8/4R3/4K2r w - - 148 90", "e1d2"),
            (3, "4k3/8/8/8/8/8/4r3/4K3 w - - 0 1", "e1e2"), (4, "4k3/8/8/8/8/8/4r3/4KN2 w - - 0 1", "e1e2"),
            (5, "4k1b1/8/8/8/8/8/4r3/4KB2 w - - 0 1", "e1e2"), (6, "4k2b/8/8/8/8/8/4r3/4KB2 w - - 0 1", "e1e2"),
            (7, "4k1n1/8/8/8/8/8/4r3/4KN2 w - - 0 1", "e1e2")]
    got = {r.id: _feats(r) for r in CF.chess_features(spark.createDataFrame(rows, "id int, FEN string, Moves string")).collect()}
    assert {i for i, f in got.items() if f == EMPTY} == {1, 3, 4, 5} and got[2][0] > 0


def test_golden_tables_are_what_the_rules_give():
    from scoutlab.plans import positions_golden as P
    from scoutlab.plans.positions import POSITIONS
    fens = {no: (fen, moves) for no, fen, moves in POSITIONS}
    for no, n_moves, n_forcing, n_pieces, n_edges, parts, checked, moves, board, rights, ep, clock, *after in P.GOLDEN:
        state = brute.parse(fens[no][0])
        legal = {brute.uci(m): m for m in brute.legal(state)}
        assert (n_moves, n_forcing, moves) == (len(legal), brute.forcing(state, list(legal.values())), " ".join(sorted(legal)))
        assert (n_pieces, n_edges, parts, checked) == (*brute.graph(state[0]), brute.checked(state[0], state[1]))
        first = (fens[no][1].split() or [""])[0]
        if first not in legal:
            assert (board, rights, ep, clock, *after) == (None,) * 4 + (0,) * 7
            continue
        then = brute.play(state, legal[first])
        assert (board, rights, ep, clock) == ("".join(then[0]), *then[2:])
        left = brute.legal(then)
        if after[0]:
            assert after[:5] == [len(left), brute.forcing(then, left), *brute.graph(then[0])]
        played = [r for r in P.REPLAYED if r[0] == no]
        for step, (_, i, move, white, cells) in enumerate(played):
            state = brute.play(state, {brute.uci(m): m for m in brute.legal(state)}[move]) if step else brute.parse(fens[no][0])
            assert (i, cells, white) == (step, "".join(state[0]), brute.parse(fens[no][0])[1])
        rest = fens[no][1].split()[len(played) - 1:]
        assert not rest or rest[0] not in {brute.uci(m) for m in brute.legal(state)}


def test_listed_moves_and_boards_match_plain_rules(spark, played):
    """The moves of C11 and the board after each, also without the boards."""
    states = played[:200]
    df = CF.parse_fen(spark.createDataFrame([(i, brute.to_fen(s)) for i, s in enumerate(states)], "id int, FEN string"))
    name = lambda m: "abcdefgh"[m.fr % 8] + str(m.fr // 8 + 1) + "abcdefgh"[m.to % 8] + str(m.to // 8 + 1) + (m.pr or "")
    plain = {r.id: [name(x.m) for x in r.legal] for r in CF.with_legal_moves(df, boards=False, keep=["id"]).collect()}
    for r in CF.with_legal_moves(df).select("id", "legal").collect():
        state = states[r.id]
        want = {brute.uci(m): list(brute.play(state, m)[0]) for m in brute.legal(state)}
        assert {name(x.m): x.b for x in r.legal} == want and len(r.legal) == len(want)
        assert plain[r.id] == [name(x.m) for x in r.legal]


def test_listed_moves_with_several_kings(spark):
    """The first king alone counts, as in the move rules on single boards."""
    df = CF.parse_fen(spark.createDataFrame([(1, "4k3/8/8/8/8/8/r7/K6K w - - 0 1"), (2, "4k3/8/8/8/8/8/7r/K6K w - - 0 1"), (3, "x")], "id int, FEN string"))
    want = df.select("id", F.expr(CF.legal_moves_expr("bd", "white", "castling", "ep")).alias("legal")).filter("id < 3").collect()
    got = {r.id: r.legal for r in CF.with_legal_moves(df).collect()}
    assert {r.id: r.legal for r in want} == {i: got[i] for i in (1, 2)} and got[3] is None


def test_positions_are_dealt_to_many_tasks(spark):
    from scoutlab.plans import standins as S
    assert S.puzzles(spark, SF_SMALL).rdd.getNumPartitions() == 1
    assert S.puzzles_with_positions(spark, SF_SMALL).rdd.getNumPartitions() >= 8
