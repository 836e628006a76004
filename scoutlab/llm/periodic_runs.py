"""Periodic runs of words by recursive frequency splitting (operator 11).

A run is a stretch of consecutive words in which words q apart are identical,
q being its smallest period, of at least max(MIN_LENGTH, MIN_PERIODS * q) words,
that neither neighbouring word extends.

Splitting.  Every word of a run occurs at least MIN_PERIODS times in it.  A word
that occurs fewer times within its segment (at first the document) is in no
run, so the segment is split there; segments too short for a run go, and the
pieces are counted again until none changes.  Splitting only prunes: the scan is
exact on any superset, so after MAX_ROUNDS what is still changing is scanned as
it is, which bounds the work on hostile texts.

Lag scan.  Surviving segments are laid end to end with separators that equal
nothing.  Lags up to SMALL are compared directly.  Larger lags are scanned a
doubling range [b, 2b) at a time: the stretch on which words q apart agree is at
least 3q words long, so it holds whole aligned blocks of b words, each of whose
hashes equals that of the block q further on.  One comparison of every block
hash with those of the aligned blocks finds all lags of the range, in time
proportional to the segment; the exact words then decide and extend.  A
candidate inside a known run of smaller period cannot be smallest (two periods
that overlap by their sum share their greatest common divisor) and is dropped.

The work on a text of n words is O(n log n); a text is read whole and alone if it
exceeds CHUNK_WORDS, so a task holds one chunk of words at a time.  There is no
shuffle: a lost executor's tasks are repeated from the input.

Null, empty and blank texts have no words and no runs; repeated rows and null
ids are rows like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scoutlab.llm.common import packed, words
from scoutlab.llm.shingles import mix

MIN_LENGTH, MIN_PERIODS = 6, 4
SMALL = 15
MAX_ROUNDS = 64
CHUNK_WORDS = 1 << 18
_U = np.uint64


def stable_words(ids: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Places (ascending) of the words that survive the splitting.

    ``ids``: word numbers; ``seg``: number of the segment (document) of each,
    ascending.
    """
    live, done = np.arange(len(ids)), []
    width = int(ids.max()) + 1 if len(ids) else 1
    for _ in range(MAX_ROUNDS):
        if not len(live):
            break
        _, inverse, counts = np.unique(seg * width + ids[live], return_inverse=True, return_counts=True)
        often = counts[inverse] >= MIN_PERIODS
        hit = np.zeros(seg[-1] + 1, bool)
        hit[seg[~often]] = True
        changed = hit[seg]
        done.append(live[~changed])
        live, seg = live[changed & often], seg[changed & often]
        if not len(live):
            break
        first = np.r_[True, (np.diff(live) != 1) | (np.diff(seg) != 0)]
        seg = np.cumsum(first) - 1
        long = np.bincount(seg)[seg] >= MIN_LENGTH
        live, seg = live[long], seg[long]
    return np.sort(np.concatenate(done + [live])) if done else live


def _stretches(x: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of period q that are long enough."""
    equal = np.zeros(len(x) - q + 2, np.int8)
    equal[1:-1] = x[:-q] == x[q:]
    edges = np.flatnonzero(np.diff(equal))
    s, e = edges[::2], edges[1::2] + q
    long = e - s >= max(MIN_LENGTH, MIN_PERIODS * q)
    return s[long], e[long]


def _reach(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """For every place the furthest end of the known runs that start there or before."""
    reach = np.zeros(n, np.int64)
    if runs:
        table = np.array(runs)
        np.maximum.at(reach, table[:, 0], table[:, 1])
        np.maximum.accumulate(reach, out=reach)
    return reach


def _chains(hashes: np.ndarray, b: int, reach: np.ndarray) -> list[tuple[int, int, int]]:
    """(first place, end, lag) of the rows of adjacent aligned blocks of b words
    whose hashes recur at one lag of [b, 2b), where enough of them do."""
    later = hashes[b:]
    rows = -(-len(later) // b)
    if not rows:
        return []
    square = np.zeros(rows * b, _U)
    square[:len(later)] = later
    same = square.reshape(rows, b) == hashes[:rows * b:b][:, None]
    same.reshape(-1)[len(later):] = False
    row, lag = np.nonzero(same)
    at, lag = row * b, lag + b
    new = reach[at] < at + lag + b
    row, lag = row[new], lag[new]
    order = np.lexsort((row, lag))
    row, lag = row[order], lag[order]
    first = np.flatnonzero(np.r_[True, (np.diff(row) != 1) | (np.diff(lag) != 0)]) if len(row) else np.empty(0, int)
    n = np.diff(np.r_[first, len(row)])
    enough = n >= ((MIN_PERIODS - 1) * lag[first] - b + 1) // b
    first, n = first[enough], n[enough]
    return list(zip((row[first] * b).tolist(), ((row[first] + n) * b).tolist(), lag[first].tolist()))


def _extended(x: np.ndarray, a: int, z: int, q: int, b: int, reach: np.ndarray) -> list[tuple[int, int, int]]:
    """The run of period q around [a, z), if the words bear it out."""
    if not np.array_equal(x[a:z], x[a + q:z + q]):  # a hash that two blocks share
        return [(s, e, q) for s, e in zip(*(v.tolist() for v in _stretches(x, q))) if reach[s] < e]
    while a:
        k = min(a, b)
        off = np.flatnonzero(x[a - k:a] != x[a - k + q:a + q])
        a -= k - 1 - int(off[-1]) if len(off) else k
        if len(off):
            break
    while z + q < len(x):
        k = min(len(x) - q - z, b)
        off = np.flatnonzero(x[z:z + k] != x[z + q:z + q + k])
        z += int(off[0]) if len(off) else k
        if len(off):
            break
    return [(a, z + q, q)] if z + q - a >= max(MIN_LENGTH, MIN_PERIODS * q) else []


def find_runs(x: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of ``x``, whose segments, at most ``longest``
    long, are divided by values that occur once."""
    runs: list[tuple[int, int, int]] = []
    reach = _reach(len(x), runs)
    for q in range(1, min(SMALL, longest // MIN_PERIODS) + 1):
        s, e = _stretches(x, q)
        new = reach[s] < e
        if new.any():
            runs += zip(s[new].tolist(), e[new].tolist(), [q] * int(new.sum()))
            reach = _reach(len(x), runs)
    hashes, b = mix(x.view(_U)), 1
    while MIN_PERIODS * b <= longest:
        if b > SMALL:
            found = set()
            for a, z, q in _chains(hashes, b, reach):
                found.update(_extended(x, a, z, q, b, reach))
            if found:
                runs += sorted(found)
                reach = _reach(len(x), runs)
        if len(hashes) <= b:
            break
        hashes = mix(hashes[:-b] * _U(0xA24BAED4963EE407) + hashes[b:])
        b *= 2
    return runs


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in texts], np.int64)
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
    live = stable_words(ids, np.repeat(np.arange(len(texts)), sizes))
    if not len(live):
        return out
    ends = np.cumsum(sizes)
    owner = np.searchsorted(ends, live, "right")
    first = np.r_[True, (np.diff(live) != 1) | (np.diff(owner) != 0)]
    seg = np.cumsum(first) - 1
    at = np.arange(len(live)) + seg  # one separator before every segment but the first
    x = -1 - np.arange(int(at[-1]) + 1, dtype=np.int64)
    x[at] = ids[live]
    places = np.full(len(x), -1, np.int64)
    places[at] = live
    for s, e, q in find_runs(x, int(np.bincount(seg).max())):
        place = int(places[s])
        doc = int(np.searchsorted(ends, place, "right"))
        out[doc].append((place - int(ends[doc] - sizes[doc]), e - s, q))
    for r in out:
        r.sort(key=lambda run: (run[0], run[2]))
    return out


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of every run only its first period."""
    if not runs:
        return b" ".join(text)
    gone = np.zeros(len(text) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([w for w, g in zip(text, np.cumsum(gone).tolist()) if not g])


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        row = 0
        while row < batch.num_rows:
            first, held, n = row, [], 0
            while row < batch.num_rows and (not held or n < CHUNK_WORDS):
                held.append((texts[row].as_py() or b"").split())  # splits at [\x20\x09-\x0D]
                n += len(held[-1])
                row += 1
            found = runs_of(held)
            runs = [[{"start": s, "length": k, "period": q} for s, k, q in r] for r in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row").slice(first, row - first), pa.array([len(w) for w in held], pa.int64()), pa.array(runs, _RUN),
                 pa.array([collapsed(w, r) for w, r in zip(held, found)], pa.binary()).cast(pa.string())],
                ["_row", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str | Column = "text") -> DataFrame:
    """_row (the row of ``docs``, less its text), n_words, runs, collapsed.

    ``runs``: start (word number from 0), length and period, by start, then
    period.  ``collapsed``: the words that no run contains after its first
    period, joined by one space.
    """
    slim = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    kind = slim.schema.simpleString()
    value = F.col(text) if isinstance(text, str) else text
    rows = packed(docs, value.alias("text")).withColumn(
        "_row", F.struct(*[F.col("_row").getField(c).alias(c) for c in slim.columns]))
    return rows.mapInArrow(
        _scan, f"_row {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """``text``, or for one doc_id in ten its words with a periodic tail.

    h = crc32 of the decimal doc_id; where h is divisible by 10 and g = h div 10,
    the words from number a = g % n on repeat those from a to a + p, with
    p = 1 + (n - a) div (3 + g % 8).  A null doc_id has no such tail.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        cut = F.struct(w.alias("w"), a.cast("int").alias("a"), p.cast("int").alias("p"))
        def build(c: Column) -> Column:
            rest = F.sequence(F.lit(0), F.size(c["w"]) - c["a"] - 1)
            repeated = F.transform(rest, lambda i: F.get(c["w"], c["a"] + i % c["p"]))
            return F.array_join(F.concat(F.slice(c["w"], 1, c["a"]), repeated), " ")
        return F.element_at(F.transform(F.array(cut), build), 1)
    made = F.element_at(F.transform(F.array(words(text)), lambda w: F.when(F.size(w) > 0, tail(w))), 1)
    return F.when(h % 10 == 0, made).otherwise(text)
