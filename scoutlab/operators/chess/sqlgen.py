"""SQL expression builders for chess positions.

A position is an ``ARRAY<STRING>`` of 64 one-letter cells indexed by square
(a1 = 0, b1 = 1, ..., h8 = 63), ``'.'`` for empty; upper case is White.
Every builder returns Spark SQL text over column / lambda names, so the
whole feature pipeline compiles to JVM higher-order functions evaluated row
by row: no explode, no join and no shuffle per position.
Square arithmetic is unrolled at generation time (offsets are constants).
"""

from __future__ import annotations

KNIGHT = [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)]
KING = [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]
DIAG = [(1, 1), (1, -1), (-1, 1), (-1, -1)]
ORTH = [(1, 0), (-1, 0), (0, 1), (0, -1)]

MOVE_TYPE = "ARRAY<STRUCT<fr: INT, to: INT, pr: STRING>>"
GEO = "_geo"  # struct column of lookup tables, added by :func:`geometry_column`


def _targets(s: int, offsets: list[tuple[int, int]], reach: int = 1) -> list[int]:
    f, r = s % 8, s // 8
    out = []
    for df, dr in offsets:
        for k in range(1, reach + 1):
            ff, rr = f + k * df, r + k * dr
            if not (0 <= ff < 8 and 0 <= rr < 8):
                break
            out.append(rr * 8 + ff)
    return out


def geometry_tables() -> dict[str, list[list[int]]]:
    """Square geometry generated from the move rules: knight and king
    steps, pawn attack squares per colour, and the eight sliding rays
    (nearest square first) for every square."""
    t = {"kn": [_targets(s, KNIGHT) for s in range(64)],
         "kg": [_targets(s, KING) for s in range(64)],
         "pw": [_targets(s, [(-1, 1), (1, 1)]) for s in range(64)],
         "pb": [_targets(s, [(-1, -1), (1, -1)]) for s in range(64)]}
    for i, d in enumerate(DIAG + ORTH):
        t[f"r{i}"] = [_targets(s, [d], 7) for s in range(64)]
    return t


def geometry_column():
    """The tables as one literal struct column (constant-folded by Catalyst,
    so every position shares it)."""
    from pyspark.sql import functions as F
    fields = ", ".join(
        f"'{k}', array(" + ", ".join(f"CAST(array({', '.join(map(str, row))}) AS ARRAY<INT>)" for row in rows) + ")"
        for k, rows in geometry_tables().items())
    return F.expr(f"named_struct({fields})").alias(GEO)


def inb(s: str, df: int, dr: int) -> str:
    """Target (file+df, rank+dr) of square ``s`` is on the board."""
    parts = []
    if df:
        parts.append(f"({s} % 8 + ({df})) BETWEEN 0 AND 7")
    if dr:
        parts.append(f"({s} div 8 + ({dr})) BETWEEN 0 AND 7")
    return " AND ".join(parts) or "true"


def sq(s: str, df: int, dr: int) -> str:
    return f"({s} + ({dr * 8 + df}))"


_STEP_TABLE = {tuple(KNIGHT): "kn", tuple(KING): "kg", ((-1, 1), (1, 1)): "pw", ((-1, -1), (1, -1)): "pb"}


def steps(s: str, offsets: list[tuple[int, int]]) -> str:
    """On-board single-step targets of ``s`` (knight / king / pawn)."""
    return f"element_at({GEO}.{_STEP_TABLE[tuple(offsets)]}, CAST(({s}) + 1 AS INT))"


def ray(s: str, df: int, dr: int) -> str:
    """On-board squares from ``s`` in one direction, nearest first."""
    return f"element_at({GEO}.r{(DIAG + ORTH).index((df, dr))}, CAST(({s}) + 1 AS INT))"


def at(bd: str, q: str) -> str:
    return f"element_at({bd}, ({q}) + 1)"


def first_blocker(bd: str, s: str, df: int, dr: int) -> str:
    """First occupied square along a ray (null when none)."""
    return f"try_element_at(filter({ray(s, df, dr)}, q -> {at(bd, 'q')} != '.'), 1)"


def letter(white: str, piece: str) -> str:
    """Piece letter of the given side (``white`` is SQL boolean text)."""
    return f"IF({white}, '{piece.upper()}', '{piece.lower()}')"


def attacked(bd: str, s: str, by_white: str) -> str:
    """Square ``s`` is attacked by side ``by_white`` on board ``bd`` (pins
    ignored, as in an attack map)."""
    n = f"exists({steps(s, KNIGHT)}, q -> {at(bd, 'q')} = {letter(by_white, 'n')})"
    k = f"exists({steps(s, KING)}, q -> {at(bd, 'q')} = {letter(by_white, 'k')})"
    # a white pawn attacks s from (f-1, r-1) / (f+1, r-1); a black one from r+1
    pw = f"exists({steps(s, [(-1, -1), (1, -1)])}, q -> {at(bd, 'q')} = 'P')"
    pb = f"exists({steps(s, [(-1, 1), (1, 1)])}, q -> {at(bd, 'q')} = 'p')"
    p = f"IF({by_white}, {pw}, {pb})"
    sl = []
    for (df, dr), kinds in [(d, "bq") for d in DIAG] + [(d, "rq") for d in ORTH]:
        fb = first_blocker(bd, s, df, dr)
        sl.append(f"coalesce({at(bd, fb)} IN ({letter(by_white, kinds[0])}, {letter(by_white, kinds[1])}), false)")
    return "(" + " OR ".join([n, k, p, *sl]) + ")"


def king_square(bd: str, white: str) -> str:
    return f"CAST(array_position({bd}, {letter(white, 'k')}) - 1 AS INT)"


def king_in_danger(bd: str, white: str) -> str:
    """Side ``white``'s king is attacked (false when it has no king)."""
    ks = king_square(bd, white)
    return f"coalesce(transform(array({ks}), kq -> kq >= 0 AND {attacked(bd, 'kq', f'NOT ({white})')})[0], false)"


def is_white(p: str) -> str:
    return f"({p} != '.' AND {p} = upper({p}))"


def own_at(bd: str, q: str, white: str) -> str:
    p = at(bd, q)
    return f"({p} != '.' AND (({p} = upper({p})) = ({white})))"


def enemy_at(bd: str, q: str, white: str) -> str:
    p = at(bd, q)
    return f"({p} != '.' AND (({p} = upper({p})) != ({white})))"


def _mv(s: str, targets: str, var: str = "q") -> str:
    return f"transform({targets}, {var} -> named_struct('fr', CAST({s} AS INT), 'to', CAST({var} AS INT), 'pr', CAST(NULL AS STRING)))"


def _slider_targets(bd: str, s: str, white: str, dirs: list[tuple[int, int]], include_own: bool) -> str:
    outs = []
    for df, dr in dirs:
        r = "rr"
        fi = f"array_position(transform({r}, q -> {at(bd, 'q')} != '.'), true)"
        if include_own:
            body = f"IF({fi} = 0, {r}, slice({r}, 1, CAST({fi} AS INT)))"
        else:
            blocked_own = own_at(bd, f"element_at({r}, CAST({fi} AS INT))", white)
            body = (f"CASE WHEN {fi} = 0 THEN {r} WHEN {blocked_own} THEN slice({r}, 1, CAST({fi} - 1 AS INT)) "
                    f"ELSE slice({r}, 1, CAST({fi} AS INT)) END")
        outs.append(f"transform(array({ray(s, df, dr)}), rr -> {body})[0]")
    return "concat(" + ", ".join(outs) + ")"


def attack_targets(bd: str, s: str) -> str:
    """``board.attacks(s)``: squares the piece on ``s`` attacks, own pieces
    included, sliders stopped by the first occupied square, pawns diagonal."""
    p = at(bd, s)
    w = is_white(p)
    return (f"CASE lower({p}) "
            f"WHEN 'n' THEN {steps(s, KNIGHT)} "
            f"WHEN 'k' THEN {steps(s, KING)} "
            f"WHEN 'p' THEN IF({w}, {steps(s, [(-1, 1), (1, 1)])}, {steps(s, [(-1, -1), (1, -1)])}) "
            f"WHEN 'b' THEN {_slider_targets(bd, s, w, DIAG, True)} "
            f"WHEN 'r' THEN {_slider_targets(bd, s, w, ORTH, True)} "
            f"WHEN 'q' THEN {_slider_targets(bd, s, w, DIAG + ORTH, True)} "
            f"ELSE CAST(array() AS ARRAY<INT>) END")


def pseudo_moves(bd: str, white: str, castling: str, ep: str, squares: str = "sequence(0, 63)") -> str:
    """Pseudo-legal moves of side ``white`` as ``ARRAY<STRUCT<fr,to,pr>>``:
    piece moves, pawn pushes / double pushes / captures / en passant,
    promotions to q r b n, and castling (rights in ``castling`` honoured
    only with king and rook at home, path empty and king not passing
    through or starting from an attacked square)."""
    s = "s"
    p = at(bd, s)
    empty = lambda q: f"({at(bd, q)} = '.')"
    fwd = f"IF({white}, 8, -8)"
    one = f"({s} + {fwd})"
    two = f"({s} + 2 * {fwd})"
    start_rank = f"IF({white}, 1, 6)"
    last_rank = f"IF({white}, 7, 0)"
    # pawn targets
    push1 = f"IF(({one}) BETWEEN 0 AND 63 AND {empty(one)}, array(CAST({one} AS INT)), CAST(array() AS ARRAY<INT>))"
    push2 = (f"IF({s} div 8 = {start_rank} AND {empty(one)} AND {empty(two)}, array(CAST({two} AS INT)), "
             f"CAST(array() AS ARRAY<INT>))")
    caps = (f"filter(IF({white}, {steps(s, [(-1, 1), (1, 1)])}, {steps(s, [(-1, -1), (1, -1)])}), "
            f"q -> {enemy_at(bd, 'q', white)} OR (q = {ep} AND {at(bd, 'q')} = '.' "
            f"AND q div 8 = IF({white}, 5, 2) AND {at(bd, f'q + IF({white}, -8, 8)')} = {letter(f'NOT ({white})', 'p')}))")
    pawn_to = f"concat({push1}, {push2}, {caps})"
    pawn_moves = (f"flatten(transform({pawn_to}, q -> IF(q div 8 = {last_rank}, "
                  f"transform(array('q', 'r', 'b', 'n'), x -> named_struct('fr', CAST({s} AS INT), 'to', CAST(q AS INT), 'pr', x)), "
                  f"array(named_struct('fr', CAST({s} AS INT), 'to', CAST(q AS INT), 'pr', CAST(NULL AS STRING))))))")
    not_own = lambda t: f"filter({t}, q -> NOT {own_at(bd, 'q', white)})"
    piece = (f"CASE lower({p}) "
             f"WHEN 'n' THEN {_mv(s, not_own(steps(s, KNIGHT)))} "
             f"WHEN 'k' THEN {_mv(s, not_own(steps(s, KING)))} "
             f"WHEN 'p' THEN {pawn_moves} "
             f"WHEN 'b' THEN {_mv(s, _slider_targets(bd, s, white, DIAG, False))} "
             f"WHEN 'r' THEN {_mv(s, _slider_targets(bd, s, white, ORTH, False))} "
             f"WHEN 'q' THEN {_mv(s, _slider_targets(bd, s, white, DIAG + ORTH, False))} "
             f"ELSE CAST(array() AS {MOVE_TYPE}) END")
    per_square = (f"flatten(transform({squares}, {s} -> IF({own_at(bd, s, white)}, {piece}, "
                  f"CAST(array() AS {MOVE_TYPE}))))")
    enemy = f"NOT ({white})"

    def castle(right_w: str, right_b: str, king_sq_w: int, rook_sq_w: int, path_w: list[int],
               safe_w: list[int], to_w: int) -> str:
        def side(right: str, off: int, white_side: bool) -> str:
            k_sq, r_sq, to = king_sq_w + off, rook_sq_w + off, to_w + off
            kl, rl = ("K", "R") if white_side else ("k", "r")
            cond = [f"instr({castling}, '{right}') > 0", f"{at(bd, str(k_sq))} = '{kl}'",
                    f"{at(bd, str(r_sq))} = '{rl}'"]
            cond += [f"{at(bd, str(q + off))} = '.'" for q in path_w]
            cond += [f"NOT {attacked(bd, str(q + off), enemy)}" for q in safe_w]
            return (f"IF({' AND '.join(cond)}, array(named_struct('fr', {k_sq}, 'to', {to}, "
                    f"'pr', CAST(NULL AS STRING))), CAST(array() AS {MOVE_TYPE}))")
        return f"IF({white}, {side(right_w, 0, True)}, {side(right_b, 56, False)})"

    king_side = castle("K", "k", 4, 7, [5, 6], [4, 5], 6)
    queen_side = castle("Q", "q", 4, 0, [1, 2, 3], [4, 3], 2)
    return f"concat({per_square}, {king_side}, {queen_side})"


def make_move(bd: str, m: str) -> str:
    """Board after move ``m`` (struct fr, to, pr): captures, promotion,
    en passant removal and the castling rook hop.  The per-move scalars are
    bound once (a one-element ``transform``) before the 64-cell rewrite."""
    pc = at(bd, f"{m}.fr")
    white = is_white(pc)
    ep_cap = (f"IF(lower({pc}) = 'p' AND {m}.fr % 8 != {m}.to % 8 AND {at(bd, f'{m}.to')} = '.', "
              f"{m}.to + IF({white}, -8, 8), -1)")
    castle = f"(lower({pc}) = 'k' AND abs({m}.to - {m}.fr) = 2)"
    rook_from = f"IF({castle}, IF({m}.to > {m}.fr, {m}.fr + 3, {m}.fr - 4), -1)"
    rook_to = f"IF({castle}, IF({m}.to > {m}.fr, {m}.fr + 1, {m}.fr - 1), -1)"
    placed = f"IF({m}.pr IS NOT NULL, IF({white}, upper({m}.pr), lower({m}.pr)), {pc})"
    z = (f"named_struct('fr', {m}.fr, 'to', {m}.to, 'pl', {placed}, 'ep', {ep_cap}, "
         f"'rf', {rook_from}, 'rt', {rook_to})")
    rook_piece = f"IF(z.rf >= 0, element_at({bd}, z.rf + 1), '.')"
    return (f"transform(array({z}), z -> transform({bd}, (x, i) -> CASE WHEN i = z.to THEN z.pl "
            f"WHEN i = z.fr THEN '.' WHEN i = z.ep THEN '.' WHEN i = z.rf THEN '.' "
            f"WHEN i = z.rt THEN {rook_piece} ELSE x END))[0]")


def is_capture(bd: str, m: str) -> str:
    pc = at(bd, f"{m}.fr")
    return (f"({at(bd, f'{m}.to')} != '.' OR (lower({pc}) = 'p' AND {m}.fr % 8 != {m}.to % 8))")
