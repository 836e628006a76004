"""Move counts, checks and attack edges on 64-bit occupancy masks, a batch at a time.

A batch of positions is a set of uint64 arrays, one entry per position, seen from
the side to move: bit 8 * rank + file, own pieces moving up the board (Black's view
is mirrored by rank, which changes no measure).  Twelve arrays hold the pieces.
Sliding attacks of all pieces in one direction come from one occluded fill (three
doubling steps), and since a ray ends at the next piece, no two rays of one
direction overlap: the number of set bits is the number of (piece, target) pairs.

Legality needs no board per move.  Attacks are taken with the own king lifted off;
pinned pieces (met both by a ray from the king and by an enemy slider from the other
side) move along their line only; a single checker must be taken or blocked, two
leave king moves alone; each en passant capture is tried on its own occupancy.  A
move gives check if its target is a square from which that piece meets the enemy
king, or if it leaves the line of an own slider to that king.
"""

from __future__ import annotations

from functools import cached_property, reduce

import numpy as np

U = np.uint64
FULL = (1 << 64) - 1
LETTERS = "PNBRQKpnbrqk"
FILES = [sum(1 << (8 * r + f) for r in range(8)) for f in range(8)]
RANKS = [0xFF << (8 * r) for r in range(8)]
# direction: (file step, rank step); a line is a pair of opposite directions
DIRS = {"n": (0, 1), "s": (0, -1), "e": (1, 0), "w": (-1, 0), "ne": (1, 1), "sw": (-1, -1), "nw": (-1, 1), "se": (1, -1)}
OPPOSITE = {"n": "s", "s": "n", "e": "w", "w": "e", "ne": "sw", "sw": "ne", "nw": "se", "se": "nw"}
LINE = {"n": "ns", "s": "ns", "e": "ew", "w": "ew", "ne": "up", "sw": "up", "nw": "down", "se": "down"}
LINES = ("ns", "ew", "up", "down")
ORTH = ("n", "s", "e", "w")
JUMPS = [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)]
MASS = {"P": 1, "N": 3, "B": 3, "R": 5, "Q": 9}  # material of a piece; a king has none


def _raw(x: np.ndarray, by: int) -> np.ndarray:
    return x << U(by) if by > 0 else x >> U(-by)


def _wrap(df: int) -> np.uint64:
    """Squares that a step of ``df`` files can end on."""
    return U(FULL & ~sum(FILES[f] for f in range(8) if not 0 <= f - df < 8))


def step(x: np.ndarray, df: int, dr: int) -> np.ndarray:
    """``x`` moved by files and ranks, what leaves the board gone."""
    return _raw(x, 8 * dr + df) & _wrap(df)


def go(x: np.ndarray, d: str) -> np.ndarray:
    return step(x, *DIRS[d])


def any_of(parts) -> np.ndarray:
    return reduce(np.bitwise_or, parts)


def bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def when(cond: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.where(cond, x, U(0))


def fill(gen: np.ndarray, empty: np.ndarray, d: str) -> np.ndarray:
    """What the sliders in ``gen`` attack in one direction, their first obstacle included."""
    by = 8 * DIRS[d][1] + DIRS[d][0]
    free = empty & _wrap(DIRS[d][0])
    for k in (1, 2, 4):
        gen = gen | (free & _raw(gen, k * by))
        free = free & _raw(free, k * by)
    return go(gen, d)


def jumps(x: np.ndarray) -> np.ndarray:
    return any_of(step(x, *j) for j in JUMPS)


def steps(x: np.ndarray) -> np.ndarray:
    return any_of(go(x, d) for d in DIRS)


class Batch:
    """Positions: ``cells`` (n x 64 ASCII codes from a1), ``white`` to move, castling
    rights as text, en passant square or -1."""

    def __init__(self, cells: np.ndarray, white: np.ndarray, castling: np.ndarray, ep: np.ndarray):
        self.cells, self.white, self.castling, self.ep = cells, white, castling, ep
        letter = (cells | 32) - 97 < 26
        mirrored = np.where(letter, cells ^ 32, cells).reshape(-1, 8, 8)[:, ::-1].reshape(-1, 64)
        view = np.where(white[:, None], cells, mirrored)
        for c in LETTERS:
            mask = np.packbits(view == ord(c), axis=1, bitorder="little").view("<u8").ravel().astype(U)
            setattr(self, c if c.isupper() else f"x{c.upper()}", mask)
        self.us = any_of([self.P, self.N, self.B, self.R, self.Q, self.K])
        self.them = any_of([self.xP, self.xN, self.xB, self.xR, self.xQ, self.xK])
        self.occ = self.us | self.them
        self.free = ~self.occ
        self.e = when(ep >= 0, self.square(np.maximum(ep, 0)))

    def square(self, s: np.ndarray) -> np.ndarray:
        """The bit of a square of White's numbering."""
        return U(1) << np.where(self.white, s, s ^ 56).astype(U)

    def sliders(self, d: str, theirs: bool) -> np.ndarray:
        if theirs:
            return (self.xR if d in ORTH else self.xB) | self.xQ
        return (self.R if d in ORTH else self.B) | self.Q

    @cached_property
    def rays(self) -> dict[str, np.ndarray]:
        """From the own king to the first piece in every direction."""
        return {d: fill(self.K, self.free, d) for d in DIRS}

    @cached_property
    def attacked(self) -> np.ndarray:
        return any_of([*self._lifted.values(), jumps(self.xN), steps(self.xK), go(self.xP, "se"), go(self.xP, "sw")])

    @cached_property
    def _lifted(self) -> dict[str, np.ndarray]:
        """Enemy slider attacks with the own king off the board."""
        return {d: fill(self.sliders(d, True), self.free | self.K, d) for d in DIRS}

    @cached_property
    def pins(self) -> dict[str, np.ndarray]:
        """Pinned pieces per line."""
        one = {d: self.rays[d] & self._lifted[OPPOSITE[d]] & self.us for d in DIRS}
        return {line: any_of(one[d] for d in DIRS if LINE[d] == line) for line in LINES}

    @cached_property
    def pinned(self) -> np.ndarray:
        return any_of(self.pins.values())

    def unpinned(self, x: np.ndarray, line: str) -> np.ndarray:
        """Pieces of ``x`` that may move along ``line``."""
        return x & ~any_of(self.pins[k] for k in LINES if k != line)

    @cached_property
    def near(self) -> np.ndarray:
        """Knights and pawns that give check."""
        return (jumps(self.K) & self.xN) | ((go(self.K, "ne") | go(self.K, "nw")) & self.xP)

    @cached_property
    def checkers(self) -> np.ndarray:
        return any_of([self.near, *(self.rays[d] & self.sliders(d, True) for d in DIRS)])

    @cached_property
    def targets(self) -> np.ndarray:
        """Where pieces other than the king may go."""
        between = any_of(when((self.rays[d] & self.sliders(d, True)) != 0, self.rays[d]) for d in DIRS)
        n = bits(self.checkers)
        return np.where(n == 0, ~self.us, when(n == 1, (self.checkers | between) & ~self.us))

    @cached_property
    def passing(self) -> list[np.ndarray]:
        """The pawn on either side of the en passant square, if it may capture."""
        taken = when((self.e & self.free & U(RANKS[5])) != 0, go(self.e, "s") & self.xP)
        out = []
        for d in ("sw", "se"):
            pawn = go(self.e, d) & self.P
            free = ~((self.occ & ~taken & ~pawn) | self.e)
            seen = any_of(fill(self.K, free, x) & self.sliders(x, True) for x in DIRS)
            out.append(when((taken != 0) & ((self.near & ~taken) == 0) & (seen == 0), pawn))
        return out

    @cached_property
    def castles(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether the king at home may castle to either side."""
        def side(right: str, rook: int, path: list[int], safe: list[int]) -> np.ndarray:
            letter = np.where(self.white, right, right.lower())
            has = np.array([a in b for a, b in zip(letter.tolist(), self.castling.tolist())], bool)
            return (has & ((self.K & U(1 << 4)) != 0) & ((self.R & U(1 << rook)) != 0)
                    & ((self.occ & U(sum(1 << s for s in path))) == 0) & ((self.attacked & U(sum(1 << s for s in safe))) == 0))
        return side("K", 7, [5, 6], [4, 5, 6]), side("Q", 0, [1, 2, 3], [2, 3, 4])

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Legal moves, and those that capture or give check.

        Where the side not to move is in check or a side has several kings, which legal
        play never gives, a check cannot be told from the target alone: these
        positions are played out move by move."""
        moves, forcing, odd = self._counts()
        at = np.flatnonzero(odd)
        if len(at):
            moves[at], forcing[at] = self.take(at)._played_out()
        return moves, forcing

    def take(self, rows: np.ndarray) -> Batch:
        return Batch(self.cells[rows], self.white[rows], self.castling[rows], self.ep[rows])

    def _played_out(self) -> tuple[np.ndarray, np.ndarray]:
        at, fr, to, promo = self.moves()
        before = self.take(at)
        pawn = (before.cells[np.arange(len(at)), fr] | 32) == ord("p")
        takes = (before.cells[np.arange(len(at)), to] != 46) | (pawn & (fr % 8 != to % 8))
        after, _ = before.play(fr, to, promo)
        hard = takes | (after.checkers != 0)
        return np.bincount(at, minlength=len(self.K)), np.bincount(at[hard], minlength=len(self.K))

    def _counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ray = {d: fill(self.xK, self.free, d) for d in DIRS}
        own = {d: fill(self.sliders(d, False), self.free, d) for d in DIRS}
        screen = {line: any_of(ray[d] & own[OPPOSITE[d]] & self.us for d in DIRS if LINE[d] == line) for line in LINES}
        leaves = {line: any_of(screen[k] for k in LINES if k != line) for line in LINES}  # moving along it uncovers a slider
        co, cd = any_of(ray[d] for d in ORTH), any_of(ray[d] for d in DIRS if d not in ORTH)
        cp, cn, every = go(self.xK, "se") | go(self.xK, "sw"), jumps(self.xK), U(FULL)
        moves, forcing = np.zeros(len(self.K), np.int64), np.zeros(len(self.K), np.int64)

        def put(to: np.ndarray, check: np.ndarray, times: int = 1) -> None:
            nonlocal moves, forcing
            moves = moves + times * bits(to)
            forcing = forcing + times * bits(to & (self.them | check))

        for d in DIRS:
            line, direct, piece = LINE[d], (co if d in ORTH else cd), (self.R if d in ORTH else self.B)
            piece = self.unpinned(piece, line)
            put(fill(piece & ~leaves[line], self.free, d) & self.targets, direct)
            put(fill(piece & leaves[line], self.free, d) & self.targets, every)
            put(fill(self.unpinned(self.Q, line), self.free, d) & self.targets, co | cd)
            put(go(self.K, d) & ~self.us & ~self.attacked, when((self.K & leaves[line]) != 0, every))
        knights, screening = self.N & ~self.pinned, any_of(screen.values())
        for j in JUMPS:
            put(step(knights & ~screening, *j) & self.targets, cn)
            put(step(knights & screening, *j) & self.targets, every)
        back, pawns = U(RANKS[7]), self.unpinned(self.P, "ns")
        through = go(ray["n"] & self.P, "n")  # the pawn's old square opens the file behind it
        for movers, sure in ((pawns & ~leaves["ns"], False), (pawns & leaves["ns"], True)):
            once = go(movers, "n") & self.free
            put(once & self.targets & ~back, every if sure else cp)
            put(go(once & U(RANKS[2]), "n") & self.free & self.targets, every if sure else cp)
            for check in (co | cd | through, co | through, cd, cn):  # queen, rook, bishop, knight
                put(once & self.targets & back, every if sure else check)
        for d in ("ne", "nw"):
            taken = go(self.unpinned(self.P, LINE[d]), d) & self.them & self.targets
            put(taken, every)
            put(taken & back, every, 3)
        for pawn in self.passing:
            moves, forcing = moves + (pawn != 0), forcing + (pawn != 0)
        for legal, rook, side in zip(self.castles, (5, 3), ("e", "w")):
            moves = moves + legal
            forcing = forcing + (legal & (((ray["s"] & U(1 << rook)) != 0) | ((ray[side] & self.K) != 0)))
        hit = (cn & self.N) | (cp & self.P) | (co & (self.R | self.Q)) | (cd & (self.B | self.Q)) | (steps(self.xK) & self.K)
        return moves, forcing, (hit != 0) | (bits(self.K) > 1) | (bits(self.xK) > 1)

    def reach(self, start: np.ndarray) -> np.ndarray:
        """Where the own piece on ``start`` (one bit a position) may legally go."""
        out = [fill(self.unpinned(self.sliders(d, False) & start, LINE[d]), self.free, d) & self.targets for d in DIRS]
        out += [jumps(self.N & start & ~self.pinned) & self.targets, steps(self.K & start) & ~self.us & ~self.attacked]
        once = go(self.unpinned(self.P & start, "ns"), "n") & self.free
        out += [once & self.targets, go(once & U(RANKS[2]), "n") & self.free & self.targets]
        out += [go(self.unpinned(self.P & start, LINE[d]), d) & self.them & self.targets for d in ("ne", "nw")]
        out += [when((pawn & start) != 0, self.e) for pawn in self.passing]
        home = (start & U(1 << 4)) != 0
        out += [when(legal & home, U(1 << s)) for legal, s in zip(self.castles, (6, 2))]
        return any_of(out)

    def legal(self, fr: np.ndarray, to: np.ndarray, promotes: np.ndarray) -> np.ndarray:
        """Whether the move between two squares (of White's numbering) is legal; ``promotes``:
        it names a piece to promote to."""
        start, end = self.square(fr), self.square(to)
        last = ((self.P & start) != 0) & ((end & U(RANKS[7])) != 0)
        return ((self.reach(start) & end) != 0) & (last == promotes)

    def moves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All legal moves: position, from and to square (of White's numbering) and code of
        the letter to promote to, or 0; by position, squares and q r b n.  The pieces
        of a position are taken one after the other, all positions at once."""
        found, left = [], self.us.copy()
        while left.any():
            start = left & (~left + U(1))
            left &= ~start
            to = self.reach(start)
            rows, end = np.nonzero(np.unpackbits(to.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            at = bits(start - U(1))[rows]  # the index of a lone bit
            found.append((rows, at, end, ((self.P & start) != 0)[rows] & (end >= 56)))
        rows, fr, to, last = (np.concatenate(v) for v in zip(*found)) if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        turn = np.where(self.white[rows], 0, 56)
        times = np.where(last, 4, 1)
        many = np.repeat(np.arange(len(rows)), times)
        nth = np.arange(len(many)) - np.repeat(np.cumsum(times) - times, times)
        promo = np.where(last[many], np.array([ord(c) for c in "qrbn"])[nth], 0)
        rows, fr, to = rows[many], (fr ^ turn)[many], (to ^ turn)[many]
        order = np.lexsort((nth, to, fr, rows))
        return rows[order], fr[order], to[order], promo[order]

    def play(self, fr: np.ndarray, to: np.ndarray, promo: np.ndarray) -> tuple[Batch, np.ndarray]:
        """The positions after legal moves, and whether the move was a capture or a pawn's;
        ``promo``: code of the lower-case letter to promote to, or 0."""
        rows, cells, white = np.arange(len(fr)), self.cells.copy(), self.white
        piece, taken = self.cells[rows, fr], self.cells[rows, to] != 46
        pawn, king = (piece | 32) == ord("p"), (piece | 32) == ord("k")
        cells[rows, fr] = 46
        cells[rows, to] = np.where(promo > 0, np.where(white, promo & 0xDF, promo), piece)
        passed = np.flatnonzero(pawn & (fr % 8 != to % 8) & ~taken)
        cells[passed, (to + np.where(white, -8, 8))[passed]] = 46
        hop = np.flatnonzero(king & (np.abs(to - fr) == 2))
        short = to[hop] > fr[hop]
        corner, beside = fr[hop] + np.where(short, 3, -4), fr[hop] + np.where(short, 1, -1)
        cells[hop, beside] = cells[hop, corner]
        cells[hop, corner] = 46
        homes = {"K": 7, "Q": 0, "k": 63, "q": 56}
        known = {text: "".join(r for r in "KQkq" if r in text) for text in set(self.castling.tolist())}
        rights = [known[text] for text in self.castling.tolist()]
        corner = np.array(list(homes.values()))
        for i in np.flatnonzero(king | np.isin(fr, corner) | np.isin(to, corner)).tolist():
            f, t, p = int(fr[i]), int(to[i]), chr(piece[i])
            rights[i] = "".join(r for r in rights[i] if homes[r] not in (f, t) and p != ("K" if r.isupper() else "k"))
        ep = np.where(pawn & (np.abs(to - fr) == 16), (fr + to) // 2, -1)
        return Batch(cells, ~white, np.array([*rights, None], object)[:-1], ep), pawn | taken

    def edges(self) -> np.ndarray:
        """(piece, attacked piece) pairs of either colour."""
        parts = [fill(self.sliders(d, theirs), self.free, d) for theirs in (False, True) for d in DIRS]
        parts += [step(x, *j) for x in (self.N, self.xN) for j in JUMPS] + [go(x, d) for x in (self.K, self.xK) for d in DIRS]
        parts += [go(self.P, "ne"), go(self.P, "nw"), go(self.xP, "se"), go(self.xP, "sw")]
        return sum(bits(p & self.occ) for p in parts)

    def components(self) -> np.ndarray:
        """Weakly connected components of the attack graph over the pieces.

        A piece's star is itself, the pieces it attacks by a step, and its next piece in
        each ascending direction if either of the two slides along it; from the lowest
        piece left, stars that touch what is reached are added until none is new."""
        one = np.ones(1, U)
        stars = np.zeros((64, len(self.occ)), U)
        for s in range(64):
            own = one << U(s)
            at = {d: fill(own, np.full(1, FULL, U), d) for d in ("n", "e", "ne", "nw")}
            here = (self.occ & own) != 0
            star = np.broadcast_to(own, self.occ.shape).copy()
            for pieces, reach in ((self.N | self.xN, jumps(own)), (self.K | self.xK, steps(own)),
                                  (self.P, go(own, "ne") | go(own, "nw")), (self.xP, go(own, "se") | go(own, "sw"))):
                star |= when((pieces & own) != 0, reach & self.occ)
            for d, ray in at.items():
                ahead = ray & self.occ
                nearest = ahead & (~ahead + U(1))
                star |= when(((nearest | own) & (self.sliders(d, False) | self.sliders(d, True))) != 0, nearest)
            stars[s] = when(here, star)
        left, n = self.occ.copy(), np.zeros(len(self.occ), np.int64)
        while left.any():
            reached = left & (~left + U(1))
            n += reached != 0
            while True:
                grown = np.bitwise_or.reduce(np.where(stars & reached, stars, U(0)), axis=0) | reached
                if np.array_equal(grown, reached):
                    break
                reached = grown
            left &= ~reached
        return n

    def material(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entropy (natural logarithm) of the material over the four quadrants, Chebyshev
        distance of the sides' centres of mass, and whether neither side can mate."""
        def mass(theirs: str, within: int) -> np.ndarray:
            return sum(w * bits(getattr(self, theirs + k) & U(within)) for k, w in MASS.items()).astype(float)

        quadrants = [sum(FILES[f] for f in fs) & sum(RANKS[r] for r in rs) for rs in (range(4), range(4, 8)) for fs in (range(4), range(4, 8))]
        parts = np.array([mass("", q) + mass("x", q) for q in quadrants])
        share = parts / np.maximum(parts.sum(0), 1)
        entropy = np.maximum(-(share * np.log(np.where(share > 0, share, 1.0))).sum(0), 0.0)
        total, centres = [], []
        for side in ("", "x"):
            total.append(mass(side, FULL))
            some = np.maximum(total[-1], 1)
            centres.append([sum(i * mass(side, lines[i]) for i in range(1, 8)) / some for lines in (FILES, RANKS)])
        apart = np.maximum(*(np.abs(a - b) for a, b in zip(*centres)))
        distance = np.where((total[0] == 0) | (total[1] == 0), 0.0, apart)
        dark = U(sum(1 << s for s in range(64) if (s % 8 + s // 8) % 2 == 0))
        bishops = self.B | self.xB
        alike = ((bishops & dark) == 0) | ((bishops & ~dark) == 0)

        def weak(a: str, b: str, side: np.ndarray) -> np.ndarray:
            mine, other = (lambda k: getattr(self, a + k)), (lambda k: getattr(self, b + k))
            knights = (bits(side) <= 2) & ((other("P") | other("N") | other("B") | other("R")) == 0)
            bishop = alike & ((self.P | self.xP | self.N | self.xN) == 0)
            return ((mine("P") | mine("R") | mine("Q")) == 0) & np.where(mine("N") != 0, knights, np.where(mine("B") != 0, bishop, True))
        return entropy, distance, weak("", "x", self.us) & weak("x", "", self.them)
