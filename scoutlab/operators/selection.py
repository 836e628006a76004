"""Exact order statistics by bracketing, for many columns and groups at once.

A double's bits, read so that their order is the order of the numbers, are a
64-bit key.  The wanted ranks of a column start with the bracket [key of the
minimum, key of the maximum]; each pass cuts every bracket into equal stretches
of keys, counts the values in them and finds the least and largest (narrow map,
bounded partial counts, summed), and keeps the stretch that holds the rank, as far
as it has values, together with the count below it.  Brackets that hold few values
are listed whole, and those of one distinct value need nothing more, so three scans
are usual and at most eight needed.

Nothing is melted, sorted, shuffled by value or checkpointed, and no task or
driver holds a column: tasks keep at most COUNTERS counters, the driver the
brackets.  The number of groups must be known to be bounded (MAX_BRACKETS);
callers use a sort-based plan beyond that.

Nulls are left out; NaN is the largest value and -0.0 is 0.0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MAX_BRACKETS = 1 << 16
COUNTERS = 1 << 20
LISTED = 1 << 16  # values listed in all by the last pass
BLOCK = 8  # columns whose extremes are aggregated together
FULL = (1 << 64) - 1
_TOP = np.uint64(1 << 63)


def keys_of(values: np.ndarray) -> np.ndarray:
    """Order-preserving 64-bit keys of doubles."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)  # one NaN, no -0.0
    bits = values.view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def value_of(key: int) -> float:
    bits = np.uint64(key)
    return float(np.array([bits ^ _TOP if bits & _TOP else ~bits], np.uint64).view(np.float64)[0])


class _Brackets:
    """Brackets of every (group, column): per slot the first key, the width of a
    stretch and the last key.  Unused slots have first > last."""

    def __init__(self, groups: int, cols: int, slots: int):
        self.first = np.full((cols, slots, groups), np.uint64(FULL), np.uint64)
        self.last = np.zeros((cols, slots, groups), np.uint64)
        self.width = np.ones((cols, slots, groups), np.uint64)


def _group_codes(batch: pa.RecordBatch, by: int, codes: dict[tuple, int]) -> np.ndarray:
    if not by:
        return np.zeros(batch.num_rows, np.int64)
    parts = [batch.column(i).dictionary_encode() for i in range(by)]
    flat = np.zeros(batch.num_rows, np.int64)
    for p in parts:
        flat = flat * (len(p.dictionary) + 1) + np.asarray(p.indices.fill_null(len(p.dictionary)), np.int64)
    kinds, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
    rows = [tuple(batch.column(i)[int(r)].as_py() for i in range(by)) for r in first]
    return np.array([codes[r] for r in rows], np.int64)[inverse]


def _columns(batch: pa.RecordBatch, by: int, codes: dict[tuple, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(column, keys, group codes) of the values that are there."""
    group = _group_codes(batch, by, codes)
    for c in range(batch.num_columns - by):
        column = batch.column(by + c)
        there = np.asarray(column.is_valid())
        yield c, keys_of(np.asarray(column.fill_null(0.0))[there]), group[there]


def _counting(b: _Brackets, bins: int, by: int, codes: dict[tuple, int]):
    cols, slots, groups = b.first.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (cols, slots, groups * bins)
        counts, low, high = np.zeros(shape, np.int64), np.full(shape, FULL, np.uint64), np.zeros(shape, np.uint64)
        for batch in batches:
            for c, keys, group in _columns(batch, by, codes):
                for t in range(slots):
                    first, last = b.first[c, t][group], b.last[c, t][group]
                    inside = (keys >= first) & (keys <= last)
                    if inside.any():
                        held = keys[inside]
                        at = ((held - first[inside]) // b.width[c, t][group[inside]]).astype(np.int64) + group[inside] * bins
                        counts[c, t] += np.bincount(at, minlength=groups * bins)
                        np.minimum.at(low[c, t], at, held)
                        np.maximum.at(high[c, t], at, held)
        found = np.flatnonzero(counts)
        ends = [pa.array((x.reshape(-1)[found] ^ _TOP).view(np.int64), pa.int64()) for x in (low, high)]  # signed, in the same order
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts.reshape(-1)[found], pa.int64()), *ends],
                                         ["at", "n", "low", "high"])
    return run


def _listing(b: _Brackets, by: int, codes: dict[tuple, int]):
    cols, slots, groups = b.first.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = [], []
            for c, keys, group in _columns(batch, by, codes):
                for t in range(slots):
                    inside = (keys >= b.first[c, t][group]) & (keys <= b.last[c, t][group])
                    places.append((c * slots + t) * groups + group[inside])
                    values.append(keys[inside])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(places), pa.int64()),
                                              pa.array(np.concatenate(values).view(np.int64), pa.int64())], ["at", "key"])
    return run


def order_statistics(df: DataFrame, cols: Sequence[str], by: Sequence[str], groups: list[tuple],
                     extremes: dict[tuple[int, int], tuple[int, float, float]],
                     wanted: dict[tuple[int, int], list[int]]) -> dict[tuple[int, int, int], float]:
    """(group, column, rank) -> value, for the ranks (from 0) in ``wanted``.

    ``groups``: the distinct values of ``by``; ``extremes``: count, minimum and
    maximum by (group number, column number)."""
    n_cols = len(cols)
    codes = {g: i for i, g in enumerate(groups)}
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    out: dict[tuple[int, int, int], float] = {}
    # (group, column) -> brackets: first key, last key, count below, count inside, ranks
    open_: dict[tuple[int, int], list[tuple[int, int, int, int, list[int]]]] = {}
    for at, ranks in wanted.items():
        n, low, high = extremes[at]
        first, last = (int(k) for k in keys_of(np.array([low, high], float)))
        open_[at] = [(first, last, 0, n, sorted(set(ranks)))] if n and ranks else []

    def settle_narrow() -> None:
        for (g, c), brackets in open_.items():
            for first, last, _, _, ranks in brackets:
                if first == last:
                    out.update({(g, c, r): value_of(first) for r in ranks})
            open_[g, c] = [x for x in brackets if x[0] != x[1]]

    def table(slots: int, bins: int) -> _Brackets:
        b = _Brackets(len(groups), n_cols, slots)
        for (g, c), brackets in open_.items():
            for t, (first, last, *_) in enumerate(brackets):
                b.first[c, t, g], b.last[c, t, g] = first, last
                b.width[c, t, g] = max(1, -(-(last - first + 1) // bins))
        return b

    while True:
        settle_narrow()
        slots = max((len(x) for x in open_.values()), default=0)
        if not slots:
            return out
        inside = sum(x[3] for brackets in open_.values() for x in brackets)
        if inside <= LISTED:
            found: dict[int, list[int]] = {}
            listed = rows.mapInArrow(_listing(table(slots, 1), len(by), codes), "at long, key long").toArrow()
            for at, key in zip(listed["at"].to_pylist(), listed["key"].to_pylist()):
                found.setdefault(at, []).append(key & FULL)
            for (g, c), brackets in open_.items():
                for t, (_, _, below, _, ranks) in enumerate(brackets):
                    keys = sorted(found.get((c * slots + t) * len(groups) + g, []))
                    out.update({(g, c, r): value_of(keys[r - below]) for r in ranks})
            return out
        bins = max(8, min(1024, COUNTERS // (slots * n_cols * len(groups))))
        b = table(slots, bins)
        counted = rows.mapInArrow(_counting(b, bins, len(by), codes), "at long, n long, low long, high long").groupBy("at").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        counts: dict[int, list[tuple[int, int, int, int]]] = {}
        for at, n, low, high in zip(*(c.to_pylist() for c in counted.toArrow().columns)):
            counts.setdefault(at // bins, []).append((at, n, low + (1 << 63), high + (1 << 63)))
        for (g, c), brackets in open_.items():
            narrower = []
            for t, (_, _, below, _, ranks) in enumerate(brackets):
                upto = below
                for _, n, low, high in sorted(counts.get((c * slots + t) * len(groups) + g, [])):
                    held = [r for r in ranks if upto <= r < upto + n]
                    if held:
                        narrower.append((low, high, upto, n, held))
                    upto += n
            open_[g, c] = narrower


def interpolated(n: int, p: float) -> tuple[int, int, float]:
    """Ranks below and above the p-quantile of n values, and the share of the upper one."""
    h = p * (n - 1)
    low = int(np.floor(h))
    return low, int(np.ceil(h)), h - low


@contextmanager
def held(df: DataFrame):
    """``df`` for several scans: kept by the executors that made it, in memory or on
    disk, until the end; what a lost executor held is made again."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def extremes_of(c: str | Column) -> list[Column]:
    """Aggregates that :func:`quantiles` needs of a column."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return [F.count(x), F.min(x), F.max(x)]


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              max_brackets: int = MAX_BRACKETS, extra: dict[str, Callable[[Column], Column]] | None = None,
              ) -> dict[tuple, dict[tuple, float | None]] | None:
    """Group values -> (column, p) -> exact quantile with linear interpolation, null for a
    column without values; nothing (None) where there are too many groups.  ``extra``
    aggregates of every column, taken in the first scan, are found by (column, name)."""
    extra = extra or {}
    most = max(1, max_brackets // (2 * max(1, len(probs)) * max(1, len(cols))))
    # Blocks of columns: an aggregate of many columns at once is not compiled.
    parts = []
    for at in range(0, len(cols), BLOCK):
        some = list(enumerate(cols))[at:at + BLOCK]
        aggs = [a.alias(f"x{i}_{j}") for i, c in some for j, a in enumerate(extremes_of(c))]
        aggs += [f(F.col(c).cast("double")).alias(f"e{i}_{name}") for i, c in some for name, f in extra.items()]
        one = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        rows = one.limit(most + 1).collect()
        if len(rows) > most:
            return None
        parts.append({tuple(r[b] for b in by): r.asDict() for r in rows})
    got = [{k: v for part in parts for k, v in part[group].items()} for group in parts[0]]
    groups = [tuple(r[b] for b in by) for r in got]
    extremes = {(g, i): (r[f"x{i}_0"], r[f"x{i}_1"], r[f"x{i}_2"]) for g, r in enumerate(got) for i in range(len(cols))}
    wanted = {at: [r for p in probs for r in interpolated(n, p)[:2]] if n else [] for at, (n, _, _) in extremes.items()}
    values = order_statistics(df, cols, by, groups, extremes, wanted)
    out: dict[tuple, dict[tuple[str, float], float | None]] = {}
    for g, group in enumerate(groups):
        of = out.setdefault(group, {})
        for i, c in enumerate(cols):
            n = extremes[g, i][0]
            of.update({(c, name): got[g][f"e{i}_{name}"] for name in extra})
            for p in probs:
                low, high, share = interpolated(n, p) if n else (0, 0, 0.0)
                below, above = values.get((g, i, low)), values.get((g, i, high))
                of[c, p] = (below + share * (above - below) if share else below) if n else None
    return out
