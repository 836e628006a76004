"""What the rules of chess give for the positions of
:mod:`scoutlab.plans.positions`, for the oracles of the chess queries.

Computed by the plain move-by-move rules in ``tests/chess_brute.py``, which share no
code with the library; ``tests/test_chess.py`` computes them again and compares.
Positions that are no valid FEN have no row.
"""

# position, legal moves, captures or checks, pieces, attack edges, components, in check,
# the moves; board, rights, en passant square and clock after the first move (null: not
# legal); the same counts, entropy and distance there (zeros: a finished game)
GOLDEN = [
    (0, 20, 0, 32, 40, 2, False, 'a2a3 a2a4 b1a3 b1c3 b2b3 b2b4 c2c3 c2c4 d2d3 d2d4 e2e3 e2e4 f2f3 f2f4 g1f3 g1h3 g2g3 g2g4 h2h3 h2h4', 'RNBQKBNRPPPP.PPP............P...................pppppppprnbqkbnr', 'KQkq', 20, 0, 20, 0, 32, 36, 4, 1.359425622975, 6.538461538462),
    (1, 20, 0, 32, 36, 4, False, 'a7a5 a7a6 b7b5 b7b6 b8a6 b8c6 c7c5 c7c6 d7d5 d7d6 e7e5 e7e6 f7f5 f7f6 g7g5 g7g6 g8f6 g8h6 h7h5 h7h6', 'RNBQKBNRPPPP.PPP............P.......p...........pppp.ppprnbqkbnr', 'KQkq', 44, 0, 29, 0, 32, 32, 6, 1.359425622975, 6.487179487179),
    (2, 30, 0, 32, 35, 5, False, 'a2a3 a2a4 b1a3 b1c3 b2b3 b2b4 c2c3 c2c4 d1e2 d1f3 d1g4 d1h5 d2d3 d2d4 e1e2 e4e5 f1a6 f1b5 f1c4 f1d3 f1e2 f2f3 f2f4 g1e2 g1f3 g1h3 g2g3 g2g4 h2h3 h2h4', 'RNBQK.NRPPPP.PPP..........B.P.....p.............pp.ppppprnbqkbnr', 'KQkq', None, 1, 21, 0, 32, 35, 5, 1.334907286632, 6.25641025641),
    (3, 22, 0, 32, 40, 4, False, 'a7a5 a7a6 b7b5 b7b6 b8a6 b8c6 c5c4 d7d5 d7d6 d8a5 d8b6 d8c7 e7e5 e7e6 f7f5 f7f6 g7g5 g7g6 g8f6 g8h6 h7h5 h7h6', 'RNBQKB.RPPPP.PPP.....N......P...q.p.............pp.ppppprnb.kbnr', 'KQkq', None, 2, 26, 0, 32, 39, 2, 1.359425622975, 5.641025641026),
    (4, 14, 1, 5, 1, 4, False, 'g1a1 g1b1 g1c1 g1d1 g1e1 g1f1 g1g2 g1g3 g1g4 g1g5 g1g6 g1g7 g1g8 g1h1', '.............r....................................k.P.R.....K...', '', None, 1, 20, 1, 5, 2, 3, 0.689009238477, 5.0),
    (5, 7, 0, 4, 0, 4, False, 'c4b3 c4b4 c4b5 c4c3 c4c5 c4d3 c4d4', '...........................kP.......p.K.........................', '', None, 1, 7, 0, 4, 3, 2, 0.69314718056, 1.0),
    (6, 29, 3, 6, 3, 3, False, 'a1a2 a1a3 a1a4 a1a5 a1a6 a1a7 a1a8 a1b1 a1c1 a1d1 d2a2 d2b2 d2c2 d2d1 d2d3 d2d4 d2d5 d2d6 d2d7 d2d8 d2e2 d2f2 d2g2 d2h2 e1c1 e1d1 e1e2 e1f1 e1f2', '..KR.......R..........................................r.....k..r', 'k', None, 1, 27, 1, 6, 6, 3, 0.69314718056, 6.0),
    (7, 28, 23, 23, 27, 4, False, 'a2a3 a2a4 c2c3 c2c4 d3d4 d5b4 d5b6 d5c3 d5c7 d5e3 d5f4 d5f6 e2d2 e2f3 e5e6 e5f6 e7a3 e7b4 e7c5 e7d6 e7d8 e7f6 e7f8 g4g5 g7e6 g7e8 g7f5 h5h6', 'q.....b.P.P.K......P..........P..p.NP..Pn....B..p..p.pNpr.bk...r', '', None, 0, 0, 0, 0, 0, 0, 0.0, 0.0),
    (8, 28, 6, 16, 17, 3, False, 'c4a3 c4a5 c4b2 c4b6 c4d2 c4d6 c4e3 c4e5 f3a8 f3b7 f3c6 f3d1 f3d5 f3e2 f3e3 f3e4 f3f1 f3f2 f3f4 f3g3 f3g4 f3h3 f3h5 g2g3 g2g4 h2g1 h2h1 h2h3', '..............PK...P.Q.....p.p.P.......p...Np.k...b..ppb.q......', '', None, 1, 25, 1, 16, 17, 3, 1.209982876831, 3.4),
    (9, 2, 1, 16, 21, 6, True, 'f4g5 h4h3', '........P.P...PP......P.......PK......P......ppkp.p...pp........', '', None, 0, 1, 1, 15, 15, 6, 1.306106609085, 3.809523809524),
    (10, 104, 28, 25, 102, 1, False, 'a1a2 a1a3 a1a4 a1a5 a1a6 a1b1 a1b2 a1c1 a1d1 a1e1 a1f1 a1g1 a7a2 a7a3 a7a4 a7a5 a7a6 a7a8 a7b6 a7b8 a7c5 a7d4 a7e3 a7f2 a7g1 b7a6 b7a8 b7b2 b7b3 b7b4 b7b5 b7b6 b7b8 b7c6 b7c8 b7d5 b7e4 b7f3 b7g2 c3a5 c3b2 c3b4 c3d2 c3d4 c3e1 c3e5 c3f6 c3g7 c7a5 c7b6 c7b8 c7c4 c7c5 c7c6 c7c8 c7d6 c7d8 c7e5 c7f4 c7g3 d7a4 d7b5 d7c6 d7c8 d7d1 d7d2 d7d3 d7d4 d7d5 d7d6 d7d8 d7e6 d7f5 d7g4 e7a3 e7b4 e7c5 e7d6 e7d8 e7e1 e7e2 e7e3 e7e4 e7e5 e7e6 e7f6 e7f7 e7g5 e7g7 h2g1 h2g2 h2g3 h2h1 h2h3 h4g3 h4g4 h4g5 h4h3 h4h5 h6g5 h6g6 h6g7 h6h5 h6h7', 'q.....R..B....qq..b...QQ......Qq......QQ......Qqq.qqq.NQ...Rbk.K', '', None, 0, 77, 37, 24, 97, 1, 1.270061976128, 2.030990833697),
    (11, 24, 7, 20, 25, 5, False, 'c3c4 d1c1 e1f1 e1g1 e1h1 e5a5 e5b5 e5c5 e5d5 e5e3 e5e4 e5e6 e5e7 e5f5 e5g5 e5h5 h6e3 h6f4 h6g5 h6g7 h8f8 h8g7 h8g8 h8h7', '...KR.......P.....P.p..r............R..p..P...bBp.p.bpp.r...knQ.', 'q', None, 1, 22, 4, 20, 25, 5, 1.029903181418, 0.92),
    (12, 2, 0, 5, 8, 1, True, 'g1g2 h2g2', '......QK......Q......q.......................................k..', '', None, 1, 26, 3, 5, 9, 1, -0.0, 1.5),
    (13, 2, 0, 5, 4, 2, True, 'g1h2 h1g2', '.......K.......Q...............q.................Q...........k..', '', None, 1, 22, 3, 5, 5, 2, 0.636514168295, 3.0),
    (14, 9, 2, 9, 16, 2, True, 'd4c4 d4d3 d4d5 d4e4 d4e5 g4e3 g4f2 h1g1 h3e3', '....qkqR....p.p.....R......K..N.................................', '', None, 1, 16, 10, 9, 17, 1, -0.0, 1.361538461538),
    (15, 0, 0, 32, 36, 4, True, '', None, None, None, None, 0, 0, 0, 0, 0, 0.0, 0.0),
    (16, 48, 8, 32, 62, 2, False, 'a1b1 a1c1 a1d1 a2a3 a2a4 b2b3 c3a4 c3b1 c3b5 c3d1 d2c1 d2e3 d2f4 d2g5 d2h6 d5d6 d5e6 e1c1 e1d1 e1f1 e1g1 e2a6 e2b5 e2c4 e2d1 e2d3 e2f1 e5c4 e5c6 e5d3 e5d7 e5f7 e5g4 e5g6 f3d3 f3e3 f3f4 f3f5 f3f6 f3g3 f3g4 f3h3 f3h5 g2g3 g2g4 g2h3 h1f1 h1g1', 'R....RK.PPPBBPPP..N..Q.p.p..P......PN...bn..pnp.p.ppqpb.r...k..r', 'kq', None, 1, 43, 7, 32, 64, 2, 1.35728639085, 4.384615384615),
    (17, 14, 2, 10, 8, 4, False, 'a5a4 a5a6 b4a4 b4b1 b4b2 b4b3 b4c4 b4d4 b4e4 b4f4 e2e3 e2e4 g2g3 g2g4', '............P.P..............R.kKP.....r...p......p.............', '', None, 0, 2, 0, 9, 6, 4, 1.043757036331, 1.803571428571),
    (18, 6, 0, 31, 54, 1, True, 'b4c5 c4c5 d2d4 f1f2 f3d4 g1h1', 'R..Q.RK.Pp.P..PPq....N..BB..P...nPP......b...nbNPppp.pppr...k..r', 'kq', None, 0, 43, 15, 31, 54, 1, 1.309913855772, 3.251012145749),
    (19, 44, 6, 28, 38, 2, False, 'a2a3 a2a4 b1a3 b1c3 b1d2 b2b3 b2b4 c1d2 c1e3 c1f4 c1g5 c1h6 c2c3 c4a6 c4b3 c4b5 c4d3 c4d5 c4e6 c4f7 d1d2 d1d3 d1d4 d1d5 d1d6 d7c8b d7c8n d7c8q d7c8r e1d2 e1f1 e1f2 e1g1 e2c3 e2d4 e2f4 e2g1 e2g3 g2g3 g2g4 h1f1 h1g1 h2h3 h2h4', 'RNBQK..RPPP.NnPP..........B...............p.....pp..bppprnQq.k.r', 'KQ', None, 0, 31, 5, 27, 38, 2, 1.305102552392, 4.398692810458),
    (20, 46, 4, 32, 62, 1, False, 'a1a2 a1b1 a1c1 a1d1 a1e1 a3a4 b2b3 b2b4 c3a2 c3a4 c3b1 c3b5 c3d1 c3d5 c4a2 c4a6 c4b3 c4b5 c4d5 c4e6 c4f7 d3d4 e2d1 e2d2 e2e1 e2e3 f1b1 f1c1 f1d1 f1e1 f3d2 f3d4 f3e1 f3e5 f3h4 g1h1 g2g3 g5c1 g5d2 g5e3 g5f4 g5f6 g5h4 g5h6 h2h3 h2h4', 'R....RK..PP.QPPPP..P.N....B.P.b...bNp.B.p.np.n...pp.qpppr....rk.', '', None, 1, 45, 5, 32, 64, 1, 1.351681194686, 4.076923076923),
    (21, 20, 0, 32, 40, 2, False, 'a2a3 a2a4 b1a3 b1c3 b2b3 b2b4 c2c3 c2c4 d2d3 d2d4 e2e3 e2e4 f2f3 f2f4 g1f3 g1h3 g2g3 g2g4 h2h3 h2h4', None, None, None, None, 0, 0, 0, 0, 0, 0.0, 0.0),
    (22, 20, 0, 32, 40, 2, False, 'a2a3 a2a4 b1a3 b1c3 b2b3 b2b4 c2c3 c2c4 d2d3 d2d4 e2e3 e2e4 f2f3 f2f4 g1f3 g1h3 g2g3 g2g4 h2h3 h2h4', None, None, None, None, 0, 0, 0, 0, 0, 0.0, 0.0),
    (23, 30, 1, 32, 37, 4, False, 'a7a5 a7a6 b7b5 b7b6 b8a6 b8c6 c7c5 c7c6 d7d5 d7d6 d8e7 d8f6 d8g5 d8h4 e5e4 e8e7 f7f5 f7f6 f8a3 f8b4 f8c5 f8d6 f8e7 g7g5 g7g6 g8e7 g8f6 g8h6 h7h5 h7h6', 'RNBQKBNRPPPPP..P.....P........Pq....p...........pppp.ppprnb.kbnr', 'KQkq', None, 1, 0, 0, 0, 0, 0, 0.0, 0.0),
]

# position, step, move, White to move at the start, board after the step
REPLAYED = [
    (0, 0, None, True, 'RNBQKBNRPPPPPPPP................................pppppppprnbqkbnr'),
    (0, 1, 'e2e4', True, 'RNBQKBNRPPPP.PPP............P...................pppppppprnbqkbnr'),
    (0, 2, 'e7e5', True, 'RNBQKBNRPPPP.PPP............P.......p...........pppp.ppprnbqkbnr'),
    (0, 3, 'g1f3', True, 'RNBQKB.RPPPP.PPP.....N......P.......p...........pppp.ppprnbqkbnr'),
    (1, 0, None, False, 'RNBQKBNRPPPP.PPP............P...................pppppppprnbqkbnr'),
    (1, 1, 'e7e5', False, 'RNBQKBNRPPPP.PPP............P.......p...........pppp.ppprnbqkbnr'),
    (1, 2, 'g1f3', False, 'RNBQKB.RPPPP.PPP.....N......P.......p...........pppp.ppprnbqkbnr'),
    (2, 0, None, True, 'RNBQKBNRPPPP.PPP............P.....p.............pp.ppppprnbqkbnr'),
    (2, 1, 'f1c4', True, 'RNBQK.NRPPPP.PPP..........B.P.....p.............pp.ppppprnbqkbnr'),
    (2, 2, 'b8c6', True, 'RNBQK.NRPPPP.PPP..........B.P.....p.......n.....pp.pppppr.bqkbnr'),
    (3, 0, None, False, 'RNBQKB.RPPPP.PPP.....N......P.....p.............pp.ppppprnbqkbnr'),
    (3, 1, 'd8a5', False, 'RNBQKB.RPPPP.PPP.....N......P...q.p.............pp.ppppprnb.kbnr'),
    (3, 2, 'c2c3', False, 'RNBQKB.RPP.P.PPP..P..N......P...q.p.............pp.ppppprnb.kbnr'),
    (4, 0, None, True, '......R......r....................................k.P.......K...'),
    (4, 1, 'g1g7', True, '.............r....................................k.P.R.....K...'),
    (4, 2, 'c7d6', True, '.............r.............................k........P.R.....K...'),
    (5, 0, None, False, '..........................k.P.......p.K.........................'),
    (5, 1, 'c4d4', False, '...........................kP.......p.K.........................'),
    (5, 2, 'g5f5', False, '...........................kP.......pK..........................'),
    (6, 0, None, True, 'R...K......R..........................................r.....k..r'),
    (6, 1, 'e1c1', True, '..KR.......R..........................................r.....k..r'),
    (6, 2, 'h8h1', True, '..KR...r...R..........................................r.....k...'),
    (7, 0, None, True, 'q.....b.P.P.K......P..........P..p.NP..Pn....n..p..pBpNpr.bk...r'),
    (7, 1, 'e7f6', True, 'q.....b.P.P.K......P..........P..p.NP..Pn....B..p..p.pNpr.bk...r'),
    (8, 0, None, True, '..............PK...P.Q....Np.p.P.......p....p.k...b..ppb.q......'),
    (8, 1, 'c4d6', True, '..............PK...P.Q.....p.p.P.......p...Np.k...b..ppb.q......'),
    (8, 2, 'c7d6', True, '..............PK...P.Q.....p.p.P.......p...bp.k......ppb.q......'),
    (9, 0, None, True, '........P.P...PP......P......PPK......q......ppkp.p...pp........'),
    (9, 1, 'f4g5', True, '........P.P...PP......P.......PK......P......ppkp.p...pp........'),
    (10, 0, None, False, 'q.....R..B....Qq..b...QQ......Qq......QQ......Qqqqqqq.NQ...Rbk.K'),
    (10, 1, 'b7g2', False, 'q.....R..B....qq..b...QQ......Qq......QQ......Qqq.qqq.NQ...Rbk.K'),
    (11, 0, None, True, '...KR.......P.....P.p..r............R..p..P...bBp.p.bpp.r...kn.Q'),
    (11, 1, 'h8g8', True, '...KR.......P.....P.p..r............R..p..P...bBp.p.bpp.r...knQ.'),
    (12, 0, None, True, '......QK.......Q.....q.......................................k..'),
    (12, 1, 'h2g2', True, '......QK......Q......q.......................................k..'),
    (12, 2, 'f3g2', True, '......QK......q..............................................k..'),
    (13, 0, None, True, '......QK.......................q.................Q...........k..'),
    (13, 1, 'g1h2', True, '.......K.......Q...............q.................Q...........k..'),
    (13, 2, 'h4h2', True, '.......K.......q.................................Q...........k..'),
    (14, 0, None, True, '....qkqR....p.p........R...K..N.................................'),
    (14, 1, 'h3e3', True, '....qkqR....p.p.....R......K..N.................................'),
    (15, 0, None, True, 'RNBQKBNRPPPPP..P.....P........Pq....p...........pppp.ppprnb.kbnr'),
    (16, 0, None, True, 'R...K..RPPPBBPPP..N..Q.p.p..P......PN...bn..pnp.p.ppqpb.r...k..r'),
    (16, 1, 'e1g1', True, 'R....RK.PPPBBPPP..N..Q.p.p..P......PN...bn..pnp.p.ppqpb.r...k..r'),
    (16, 2, 'b4c3', True, 'R....RK.PPPBBPPP..p..Q.p....P......PN...bn..pnp.p.ppqpb.r...k..r'),
    (17, 0, None, True, '............P.P..........R...p.kKP.....r...p......p.............'),
    (17, 1, 'b4f4', True, '............P.P..............R.kKP.....r...p......p.............'),
    (17, 2, 'h4g3', True, '............P.P.......k......R..KP.....r...p......p.............'),
    (18, 0, None, True, 'R..Q.RK.Pp.P..PPq....N..BBP.P...nP.......b...nbNPppp.pppr...k..r'),
    (18, 1, 'c4c5', True, 'R..Q.RK.Pp.P..PPq....N..BB..P...nPP......b...nbNPppp.pppr...k..r'),
    (18, 2, 'b6c5', True, 'R..Q.RK.Pp.P..PPq....N..BB..P...nPb..........nbNPppp.pppr...k..r'),
    (19, 0, None, True, 'RNBQK..RPPP.NnPP..........B...............p.....pp.Pbppprnbq.k.r'),
    (19, 1, 'd7c8q', True, 'RNBQK..RPPP.NnPP..........B...............p.....pp..bppprnQq.k.r'),
    (19, 2, 'e7c5', True, 'RNBQK..RPPP.NnPP..........B.......b.......p.....pp...ppprnQq.k.r'),
    (20, 0, None, True, 'R....RK..PP.QPPPP.NP.N....B.P.b...b.p.B.p.np.n...pp.qpppr....rk.'),
    (20, 1, 'c3d5', True, 'R....RK..PP.QPPPP..P.N....B.P.b...bNp.B.p.np.n...pp.qpppr....rk.'),
    (20, 2, 'f6d5', True, 'R....RK..PP.QPPPP..P.N....B.P.b...bnp.B.p.np.....pp.qpppr....rk.'),
    (21, 0, None, True, 'RNBQKBNRPPPPPPPP................................pppppppprnbqkbnr'),
    (22, 0, None, True, 'RNBQKBNRPPPPPPPP................................pppppppprnbqkbnr'),
    (23, 0, None, False, 'RNBQKBNRPPPPP..P.....P........P.....p...........pppp.ppprnbqkbnr'),
    (23, 1, 'd8h4', False, 'RNBQKBNRPPPPP..P.....P........Pq....p...........pppp.ppprnb.kbnr'),
]


def _values(rows: list[tuple]) -> str:
    def text(v) -> str:
        return "NULL" if v is None else repr(v).lower() if isinstance(v, bool) else repr(v)
    return ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)


def golden_sql() -> str:
    return (f"golden(position_no, n_moves, n_forcing, n_pieces, n_edges, parts, checked, moves, board_after, castling, ep, clock, "
            f"a_moves, a_forcing, a_pieces, a_edges, a_parts, a_entropy, a_distance) AS (VALUES {_values(GOLDEN)})")


def replayed_sql() -> str:
    return f"replayed(position_no, step, move, flip, board) AS (VALUES {_values(REPLAYED)})"
