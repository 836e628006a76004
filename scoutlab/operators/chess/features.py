"""Chess position features (C1-C17) as column expressions.

Pipeline for one puzzle row (FEN, Moves):

1. C1/C2 parse: the FEN board becomes a 64-cell array; side, castling, en
   passant and clocks are split out; a malformed FEN is flagged.
2. C11 legal moves of the FEN position; C16 the first move must be one of
   them; C3 the move is applied (castling rook hop, en passant removal,
   promotion) and side, rights, en passant square and clocks are updated.
3. On the resulting position: C12 branching factor, C13 forcing index
   (captures or checks), C6/C7 attack graph and density, C8 weakly
   connected components, C9 spatial entropy, C10 Chebyshev distance of the
   centres of mass; C15 a finished game (mate, stalemate, insufficient
   material, 75-move rule) gives the empty features.

All of it is a narrow map of the puzzle table: no shuffle, and the features are
joined to nothing — they are computed in place, which also replaces the
reference's positional concat (J7).  FENs are parsed by built-in functions; the
counts of a whole Arrow batch are arithmetic on arrays of 64-bit masks
(:mod:`masks`), a few microseconds a position, where lambdas over 64-cell arrays took
milliseconds.  The move lists themselves (C11) are column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from scoutlab.operators.chess import masks as M, sqlgen as G

EMPTY_FEATURES = {"branching_factor": 0, "forcing_index": 0.0, "graph_density": 0.0,
                  "tension_components": 0, "spatial_entropy": 0.0, "com_chebyshev_dist": 0.0}

FEATURE_COLUMNS = list(EMPTY_FEATURES)

_BOARD_RE = r"^([pnbrqkPNBRQK1-8]+/){7}[pnbrqkPNBRQK1-8]+$"


def _expand_digits(c: Column) -> Column:
    out = c
    for d in range(8, 0, -1):
        out = F.replace(out, F.lit(str(d)), F.lit("." * d))
    return out


def parse_fen(df: DataFrame, fen: str = "FEN", prefix: str = "") -> DataFrame:
    """C1 + C2: adds ``{prefix}bd`` (64 cells by square), ``{prefix}white``
    (side to move), ``{prefix}castling``, ``{prefix}ep`` (square or null),
    ``{prefix}halfmove``, ``{prefix}fullmove`` and ``{prefix}fen_ok``."""
    parts = F.split(F.trim(F.col(fen)), r"\s+")
    board = F.element_at(parts, 1)
    ranks = F.split(board, "/")
    expanded = _expand_digits(board)
    fields_ok = (F.size(parts) <= 6)
    board_ok = (board.rlike(_BOARD_RE) & ~board.rlike("[1-8]{2}")
                & F.forall(F.split(expanded, "/"), lambda r: F.length(r) == 8)
                & (F.size(ranks) == 8))
    turn = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("w"))
    castling = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("-"))
    ep_txt = F.coalesce(F.try_element_at(parts, F.lit(4)), F.lit("-"))
    half = F.coalesce(F.try_element_at(parts, F.lit(5)), F.lit("0"))
    full = F.coalesce(F.try_element_at(parts, F.lit(6)), F.lit("1"))
    ok = (fields_ok & board_ok & turn.isin("w", "b") & castling.rlike(r"^(-|[KQkqA-Ha-h]+)$")
          & ep_txt.rlike(r"^(-|[a-h][1-8])$") & half.rlike(r"^[0-9]+$") & full.rlike(r"^[0-9]+$"))
    # FEN lists rank 8 first; the cells start at a1
    bd = F.when(ok, F.regexp_extract_all(F.concat_ws("", F.reverse(F.split(expanded, "/"))), F.lit("."), F.lit(0)))
    ep_sq = F.when(ep_txt != "-", (F.ascii(F.substring(ep_txt, 1, 1)) - 97)
                   + (F.substring(ep_txt, 2, 1).cast("int") - 1) * 8)
    if G.GEO not in df.columns:
        df = df.withColumn(G.GEO, G.geometry_column())
    out = (df.withColumn(f"{prefix}fen_ok", F.coalesce(ok, F.lit(False)))
           .withColumn(f"{prefix}bd", bd)
           .withColumn(f"{prefix}white", turn == "w")
           .withColumn(f"{prefix}castling", castling)
           .withColumn(f"{prefix}ep", F.when(ok, ep_sq).cast("int"))
           .withColumn(f"{prefix}halfmove", F.when(ok, half.try_cast("int")))
           .withColumn(f"{prefix}fullmove", F.when(ok, full.try_cast("int"))))
    return out


def fen_pieces(df: DataFrame, key: str, fen: str = "FEN") -> DataFrame:
    """C1 as rows: ``(key, square, piece)`` for every occupied square of a
    valid FEN (``posexplode`` of the board, one row per piece)."""
    p = parse_fen(df.select(key, fen), fen)
    return (p.filter("fen_ok").select(key, F.posexplode("bd").alias("square", "piece"))
            .filter(F.col("piece") != "."))


def parse_uci(c: Column) -> Column:
    """UCI text -> struct(fr, to, pr); malformed -> null."""
    ok = c.rlike(r"^[a-h][1-8][a-h][1-8][qrbn]?$")
    sq = lambda pos: ((F.ascii(F.substring(c, pos, 1)) - 97)
                      + (F.substring(c, pos + 1, 1).cast("int") - 1) * 8)
    pr = F.when(F.length(c) == 5, F.substring(c, 5, 1))
    return F.when(ok, F.struct(sq(1).cast("int").alias("fr"), sq(3).cast("int").alias("to"),
                               pr.cast("string").alias("pr")))


def legal_moves_expr(bd: str, white: str, castling: str, ep: str, squares: str = "sequence(0, 63)") -> str:
    """C11: legal moves with the board after each, as
    ``ARRAY<STRUCT<m: STRUCT<fr,to,pr>, b: ARRAY<STRING>>>``; ``squares``
    restricts generation to pieces on those squares."""
    pseudo = G.pseudo_moves(bd, white, castling, ep, squares)
    return (f"filter(transform({pseudo}, m -> named_struct('m', m, 'b', {G.make_move(bd, 'm')})), "
            f"x -> NOT {G.king_in_danger('x.b', white)})")


STATE = ("bd", "white", "castling", "ep")


def _batch(rows: pa.RecordBatch) -> tuple[np.ndarray, M.Batch]:
    """Which rows hold a position (columns _cells, _white, _castling, _ep), and these."""
    cells = rows.column("_cells")
    there = np.flatnonzero(np.asarray(pc.equal(pc.fill_null(pc.utf8_length(cells), 0), 64)))
    some = rows.take(pa.array(there))
    text = np.frombuffer("".join(some.column("_cells").to_pylist()).encode("ascii"), np.uint8).reshape(-1, 64)
    ep = np.asarray(some.column("_ep").fill_null(-1), np.int64)
    return there, M.Batch(text, np.asarray(some.column("_white").to_pylist(), bool), np.array(some.column("_castling").to_pylist() + [""], object)[:-1], ep)


def _spread(n: int, there: np.ndarray, kind: pa.DataType, values) -> pa.Array:
    """Values of the rows in ``there``; null in the others."""
    at = np.full(n, -1)
    at[there] = np.arange(len(there))
    found = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return found.cast(kind).take(pa.array(at, mask=at < 0))


def _by_batch(df: DataFrame, state: tuple[str, str, str, str], outputs: dict[str, str], fn, *more: Column,
              keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns in ``keep``, or all) with the ``outputs`` (name -> type) that
    ``fn(rows, there, batch)`` gives as (arrow type, values of the rows in ``there``);
    ``more`` columns travel to it."""
    bd, white, castling, ep = state
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)])
    sent = df.select(row.alias("_row"), F.when(F.col(bd).isNotNull(), F.concat_ws("", bd)).alias("_cells"), F.col(white).alias("_white"),
                     F.coalesce(castling, F.lit("")).alias("_castling"), F.col(ep).cast("int").alias("_ep"), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            there, batch = _batch(rows)
            got = fn(rows, there, batch)
            yield pa.RecordBatch.from_arrays(
                [rows.column("_row"), *[_spread(rows.num_rows, there, *got[name]) for name in outputs]], ["_row", *outputs])

    kind = ", ".join([f"_row {sent.schema['_row'].dataType.simpleString()}", *[f"{k} {v}" for k, v in outputs.items()]])
    return sent.mapInArrow(run, kind).select("_row.*", *outputs)


_LETTERS = pa.array([chr(i) for i in range(128)])


def _listed(boards: bool):
    def run(rows: pa.RecordBatch, there: np.ndarray, batch: M.Batch) -> dict[str, tuple]:
        at, fr, to, promo = batch.moves()
        pr = _LETTERS.take(pa.array(promo, mask=promo == 0))
        fields = {"m": pa.StructArray.from_arrays([pa.array(fr, pa.int32()), pa.array(to, pa.int32()), pr], ["fr", "to", "pr"])}
        if boards:
            cells = batch.take(at).play(fr, to, promo)[0].cells
            one = pa.StringArray.from_buffers(cells.size, pa.py_buffer(np.arange(cells.size + 1, dtype=np.int32)), pa.py_buffer(cells.tobytes()))
            fields["b"] = pa.ListArray.from_arrays(np.arange(0, cells.size + 1, 64, dtype=np.int32), one)
        starts = np.searchsorted(at, np.arange(len(there) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays(list(fields.values()), list(fields)))
        return {"_listed": (lists.type, lists)}
    return run


def with_legal_moves(df: DataFrame, prefix: str = "", boards: bool = True, keep: list[str] | None = None) -> DataFrame:
    """C11: adds ``{prefix}legal`` for rows with a valid position, the legal moves as
    ``ARRAY<STRUCT<m: STRUCT<fr,to,pr>, b: ARRAY<STRING>>>`` by squares; without
    ``boards`` the board after each is left out.  ``keep``: columns to return beside it.

    A batch's moves are listed together on masks.  Where the side to move has several
    kings, the first alone counts, which only :func:`legal_moves_expr` knows."""
    cols = [c for c in (df.columns if keep is None else keep) if c != G.GEO]
    state = tuple(f"{prefix}{c}" for c in STATE)
    geo = df if G.GEO in df.columns else df.withColumn(G.GEO, G.geometry_column())
    e = legal_moves_expr(*[f"`{c}`" for c in state])
    king = F.when(F.col(state[1]), F.lit("K")).otherwise(F.lit("k"))
    several = F.col(f"{prefix}fen_ok") & (F.size(F.filter(F.col(state[0]), lambda x: x == king)) > 1)
    sent = geo.withColumn("_played", F.when(several, F.expr(e if boards else f"transform({e}, x -> named_struct('m', x.m))"))).drop(G.GEO)
    kind = "array<struct<m: struct<fr: int, to: int, pr: string>" + (", b: array<string>>>" if boards else ">>")
    out = _by_batch(sent, state, {"_listed": kind}, _listed(boards), keep=[*cols, "_played"])
    out = out.select(*cols, F.coalesce("_played", "_listed").alias(f"{prefix}legal"))
    return out.withColumn(G.GEO, G.geometry_column()) if keep is None and G.GEO in df.columns else out


MEASURES = {"at_moves": "long", "at_forcing": "long", "at_pieces": "long", "at_edges": "long", "at_parts": "long",
            "at_entropy": "double", "at_distance": "double", "at_dead": "boolean", "at_checked": "boolean"}


def _measure(rows: pa.RecordBatch, there: np.ndarray, batch: M.Batch) -> dict[str, tuple]:
    moves, forcing = batch.counts()
    entropy, distance, dead = batch.material()
    counts = {"at_moves": moves, "at_forcing": forcing, "at_pieces": M.bits(batch.occ), "at_edges": batch.edges(), "at_parts": batch.components()}
    flags = {"at_dead": dead, "at_checked": batch.checkers != 0}
    return ({k: (pa.int64(), v) for k, v in counts.items()} | {k: (pa.bool_(), v) for k, v in flags.items()}
            | {"at_entropy": (pa.float64(), entropy), "at_distance": (pa.float64(), distance)})


def measured(df: DataFrame, state: tuple[str, str, str, str] = STATE, keep: list[str] | None = None) -> DataFrame:
    """C6-C10 and C12-C15 of the positions in ``state`` (board, side, rights, en passant
    square): adds at_moves and at_forcing (captures or checks) of the side to move,
    at_pieces, at_edges (attacks on occupied squares), at_parts (weak components),
    at_entropy (of the material over four quadrants), at_distance (of the sides' centres
    of mass), at_dead (neither can mate), at_checked; null without a board.  ``keep``:
    the columns of ``df`` to return beside them."""
    return _by_batch(df, state, MEASURES, _measure, keep=keep)


def _density() -> Column:
    v = F.col("at_pieces")
    return F.when(v > 1, F.col("at_edges") / (v * (v - 1))).otherwise(F.lit(0.0)).cast("double")


def _forcing_index() -> Column:
    n = F.col("at_moves")
    return F.when(n > 0, F.col("at_forcing") / n).otherwise(F.lit(0.0))


def _strings(cells: np.ndarray) -> list[str]:
    flat = cells.tobytes().decode("ascii")
    return [flat[i:i + 64] for i in range(0, len(flat), 64)]


def _first_move(rows: pa.RecordBatch, there: np.ndarray, batch: M.Batch) -> dict[str, tuple]:
    some = rows.take(pa.array(there))
    given = np.asarray(some.column("_fr").is_valid())
    fr, to, promo = (np.asarray(some.column(c).fill_null(0), np.int64) for c in ("_fr", "_to", "_promo"))
    ok = given & batch.legal(fr, to, promo > 0)
    after, reset = batch.play(*(np.where(ok, x, 0) for x in (fr, to, promo)))  # a piece put on its own square where not
    return {"move_ok": (pa.bool_(), ok), "_board": (pa.string(), _strings(after.cells)), "a_castling": (pa.string(), after.castling.tolist()),
            "a_ep": (pa.int32(), pa.array(after.ep, mask=after.ep < 0)), "_reset": (pa.bool_(), reset)}


def apply_first_move(df: DataFrame, moves: str = "Moves", keep: list[str] | None = None) -> DataFrame:
    """C3 + C16: validate the first move of ``moves`` against the legal
    moves of the parsed FEN position and build the position after it
    (``a_bd``, ``a_white``, ``a_castling``, ``a_ep``, ``a_halfmove``) and
    ``move_ok``.  ``keep``: the columns of ``df`` to return beside them (and the
    side and clock)."""
    df = df.drop(G.GEO)
    first = F.split(F.coalesce(F.col(moves), F.lit("")), " ").getItem(0)
    mv = parse_uci(first)
    outputs = {"move_ok": "boolean", "_board": "string", "a_castling": "string", "a_ep": "int", "_reset": "boolean"}
    out = _by_batch(df, STATE, outputs, _first_move, mv["fr"].alias("_fr"), mv["to"].alias("_to"), F.ascii(mv["pr"]).alias("_promo"),
                    keep=None if keep is None else [*keep, *(c for c in ("white", "halfmove") if c not in keep)])
    out = out.withColumn("move_ok", F.coalesce(F.col("move_ok"), F.lit(False)))
    ok, cells = F.col("move_ok"), F.regexp_extract_all(F.col("_board"), F.lit("."), F.lit(0))
    return out.withColumns({
        "a_bd": F.when(ok, cells), "a_white": ~F.col("white"), "a_castling": F.when(ok, F.col("a_castling")), "a_ep": F.when(ok, F.col("a_ep")),
        "a_halfmove": F.when(ok, F.when(F.col("_reset"), F.lit(0)).otherwise(F.col("halfmove") + 1)),
    }).drop("_board", "_reset")


def chess_features(df: DataFrame, fen: str = "FEN", moves: str = "Moves",
                   keep: list[str] | None = None) -> DataFrame:
    """C17: the whole feature pipeline (``muestra`` -> ``muestra_procesada``):
    the input columns plus the six features, empty values on any failure
    or on a finished game."""
    cols = keep if keep is not None else df.columns
    after = apply_first_move(parse_fen(df, fen), moves, keep=cols)
    after = measured(after, ("a_bd", "a_white", "a_castling", "a_ep"), keep=[*cols, "move_ok", "a_halfmove"])
    n = F.col("at_moves")
    over = (n == 0) | F.col("at_dead") | (F.col("a_halfmove") >= 150)
    good = F.col("move_ok") & ~F.coalesce(over, F.lit(True))
    feats = {
        "branching_factor": n.cast("int"),
        "forcing_index": _forcing_index(),
        "graph_density": _density(),
        "tension_components": F.col("at_parts").cast("int"),
        "spatial_entropy": F.col("at_entropy"),
        "com_chebyshev_dist": F.col("at_distance"),
    }
    return after.select(*cols, *[F.when(good, c).otherwise(F.lit(EMPTY_FEATURES[n])).alias(n)
                                 for n, c in feats.items()])


def board_features(df: DataFrame, fen: str = "FEN", keep: list[str] | None = None) -> DataFrame:
    """The same measurements on the FEN position as written (no move
    pushed): legal moves, forcing index, V, E, density, components,
    entropy and centre-of-mass distance (the golden-table view)."""
    cols = keep if keep is not None else df.columns
    base = measured(parse_fen(df, fen).drop(G.GEO), keep=[*cols, "fen_ok"])
    return base.select(*cols, "fen_ok", F.col("at_moves").cast("int").alias("branching_factor"),
                       _forcing_index().alias("forcing_index"), F.col("at_pieces").cast("int").alias("n_pieces"),
                       F.col("at_edges").cast("int").alias("n_edges"), _density().alias("graph_density"),
                       F.col("at_parts").cast("int").alias("tension_components"), F.col("at_entropy").alias("spatial_entropy"),
                       F.col("at_distance").alias("com_chebyshev_dist"), F.col("at_checked").alias("in_check"))


_STEPS = pa.list_(pa.struct([("move", pa.string()), ("board", pa.string())]))
_UCI = re.compile(r"([a-h])([1-8])([a-h])([1-8])([qrbn]?)")


def _replay(rows: pa.RecordBatch, there: np.ndarray, batch: M.Batch) -> dict[str, tuple]:
    """All games of a batch move by move, each until its first malformed or illegal move."""
    lists = rows.column("_played").take(pa.array(there)).to_pylist()
    steps = [[{"move": None, "board": b}] for b in _strings(batch.cells)]
    alive, ply = np.arange(len(there)), 0
    while len(alive):
        texts = [lists[g][ply] if ply < len(lists[g]) else "" for g in alive.tolist()]
        found = [_UCI.fullmatch(t) for t in texts]
        parts = [m.groups() if m else ("a", "1", "a", "1", "") for m in found]
        fr, to = (np.array([ord(p[i]) - 97 + 8 * (int(p[i + 1]) - 1) for p in parts], np.int64) for i in (0, 2))
        promo = np.array([ord(p[4]) if p[4] else 0 for p in parts], np.int64)
        on = np.array([m is not None for m in found], bool) & batch.legal(fr, to, promo > 0)
        batch = M.Batch(batch.cells[on], batch.white[on], batch.castling[on], batch.ep[on])
        batch, _ = batch.play(fr[on], to[on], promo[on])
        alive = alive[on]
        for g, board in zip(alive.tolist(), _strings(batch.cells)):
            steps[g].append({"move": lists[g][ply], "board": board})
        ply += 1
    return {"_steps": (_STEPS, pa.array(steps, _STEPS))}


def replay_positions(df: DataFrame, key: str, fen: str = "FEN", moves: str = "Moves") -> DataFrame:
    """C4 + C5: one board per step (step 0 = the FEN position), the moves
    applied in order; ``flip`` is true when White is to move in the FEN (the
    solver plays Black).

    The full state (board, side, rights, en passant square) goes from step to
    step, and a puzzle's replay stops before its first malformed or illegal move.
    Null or empty move lists give step 0 alone.  One narrow job, whatever the
    longest game: a batch's games are played on together."""
    played = F.filter(F.split(F.trim(F.coalesce(F.col(moves), F.lit(""))), r"\s+"), lambda m: m != "")
    at = parse_fen(df.select(key, fen, moves), fen).filter("fen_ok").drop(G.GEO)
    out = _by_batch(at, STATE, {"_steps": "array<struct<move: string, board: string>>"}, _replay, played.alias("_played"), keep=[key, "white"])
    return (out.select(key, "white", F.posexplode("_steps").alias("step", "at"))
            .select(key, "step", "at.move", F.col("white").alias("flip"), "at.board"))
