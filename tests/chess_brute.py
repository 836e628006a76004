"""Plain chess rules on a list of 64 letters, for holding the library's masks against."""

import random

STEPS = {"n": [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)],
         "b": [(1, 1), (1, -1), (-1, 1), (-1, -1)], "r": [(1, 0), (-1, 0), (0, 1), (0, -1)]}
STEPS["q"] = STEPS["k"] = STEPS["b"] + STEPS["r"]


def parse(fen):
    board, turn, rights, ep, half, _ = fen.split()
    rows = ["".join("." * int(c) if c.isdigit() else c for c in r) for r in board.split("/")]
    cells = list("".join(reversed(rows)))
    return cells, turn == "w", rights, None if ep == "-" else ord(ep[0]) - 97 + 8 * (int(ep[1]) - 1), int(half)


def to_fen(state):
    cells, white, rights, ep, half = state
    rows = []
    for r in range(7, -1, -1):
        row, gap = "", 0
        for c in cells[8 * r:8 * r + 8]:
            row, gap = (row, gap + 1) if c == "." else (row + (str(gap) if gap else "") + c, 0)
        rows.append(row + (str(gap) if gap else ""))
    square = "-" if ep is None else chr(97 + ep % 8) + str(ep // 8 + 1)
    return f"{'/'.join(rows)} {'w' if white else 'b'} {rights or '-'} {square} {half} 1"


def targets(cells, s):
    """Squares the piece on ``s`` attacks."""
    p, (f, r) = cells[s].lower(), (s % 8, s // 8)
    if p == "p":
        up = 1 if cells[s] == "P" else -1
        return [8 * (r + up) + f + d for d in (-1, 1) if 0 <= f + d < 8 and 0 <= r + up < 8]
    out = []
    for df, dr in STEPS.get(p, []):
        a, b = f + df, r + dr
        while 0 <= a < 8 and 0 <= b < 8:
            out.append(8 * b + a)
            if p in "nk" or cells[8 * b + a] != ".":
                break
            a, b = a + df, b + dr
    return out


def attacked(cells, s, by_white):
    return any(c != "." and c.isupper() == by_white and s in targets(cells, i) for i, c in enumerate(cells))


def checked(cells, white):
    king = "K" if white else "k"
    return king in cells and attacked(cells, cells.index(king), not white)


def play(state, move):
    cells, white, rights, ep, half = state
    fr, to, pr = move
    new, p = list(cells), cells[fr]
    taken = cells[to] != "."
    if p in "Pp" and fr % 8 != to % 8 and not taken:
        new[to + (-8 if white else 8)] = "."
        taken = True
    if p in "Kk" and abs(to - fr) == 2:
        a, b = (fr + 3, fr + 1) if to > fr else (fr - 4, fr - 1)
        new[a], new[b] = ".", cells[a]
    new[to], new[fr] = (pr.upper() if white else pr) if pr else p, "."
    lost = {"K": {4, 7}, "Q": {4, 0}, "k": {60, 63}, "q": {60, 56}}
    kept = "".join(c for c in rights if c in lost and not (fr in lost[c] or (to in lost[c] and to not in (4, 60))))
    return (new, not white, kept, (fr + to) // 2 if p in "Pp" and abs(to - fr) == 16 else None, 0 if taken or p in "Pp" else half + 1)


def legal(state):
    cells, white, rights, ep, _ = state
    out = []
    for s, p in enumerate(cells):
        if p == "." or p.isupper() != white:
            continue
        if p in "Pp":
            up, last = (8, 7) if white else (-8, 0)
            to = [t for t in targets(cells, s) if cells[t] != "." and cells[t].isupper() != white
                  or (t == ep and cells[t] == "." and t // 8 == (5 if white else 2) and cells[t - up] == ("p" if white else "P"))]
            if 0 <= s + up < 64 and cells[s + up] == ".":
                to.append(s + up)
                if s // 8 == (1 if white else 6) and cells[s + 2 * up] == ".":
                    to.append(s + 2 * up)
            out += [(s, t, pr) for t in to for pr in ("qrbn" if t // 8 == last else [None])]
        else:
            out += [(s, t, None) for t in targets(cells, s) if cells[t] == "." or cells[t].isupper() != white]
    home = 0 if white else 56
    for right, rook, path, safe, to in (("K", 7, (5, 6), (4, 5, 6), 6), ("Q", 0, (1, 2, 3), (4, 3, 2), 2)):
        if ((right if white else right.lower()) in rights and cells[home + 4] == ("K" if white else "k")
                and cells[home + rook] == ("R" if white else "r") and all(cells[home + q] == "." for q in path)
                and not any(attacked(cells, home + q, not white) for q in safe)):
            out.append((home + 4, home + to, None))
    return [m for m in out if not checked(play(state, m)[0], white)]


def forcing(state, moves):
    cells, white = state[:2]
    return sum(cells[t] != "." or (cells[f] in "Pp" and f % 8 != t % 8) or checked(play(state, (f, t, p))[0], not white) for f, t, p in moves)


def graph(cells):
    """(pieces, edges, weak components)."""
    part = {i: i for i, c in enumerate(cells) if c != "."}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    edges = [(s, t) for s in part for t in targets(cells, s) if cells[t] != "."]
    for s, t in edges:
        part[find(s)] = find(t)
    return len(part), len(edges), len({find(x) for x in part})


def uci(move):
    f, t, p = move
    return f"{chr(97 + f % 8)}{f // 8 + 1}{chr(97 + t % 8)}{t // 8 + 1}{p or ''}"


def positions(fens, games, plies, seed):
    """Positions met in random games; captures and checks are played more often."""
    rng = random.Random(seed)
    out = []
    for _ in range(games):
        state = parse(rng.choice(fens))
        for _ in range(rng.randrange(1, plies)):
            moves = legal(state)
            if not moves:
                break
            sharp = [m for m in moves if forcing(state, [m])]
            state = play(state, rng.choice(sharp if sharp and rng.random() < 0.4 else moves))
        out.append(state)
    return out
