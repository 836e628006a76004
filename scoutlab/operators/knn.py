"""Exact k nearest donors (nan-Euclidean) of the rows that miss a feature.

A donor of target t with the features D meets a receiver with the features R on the
features S that both have; one such (t, D, S) is a group.  A bounded sample of the rows
cuts each group's space into regions of about equal numbers of donors; where points
cannot be told apart a region is dealt to several tasks.  Every donor goes to its
region.  A receiver's k-th distance to the sample in its own region bounds the true one,
so it goes to the regions within that bound, and the best of each are merged.  Exact
whatever the sample: it sets the sizes of regions, not the result.

Within a region equal donors beyond the k smallest keys are left out, equal receivers
are searched for once, and the search meets blocks of points within the bound only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_FEATURES = 62  # presence masks are BIGINT
SAMPLE_ROWS = 30_000  # rows that shape the regions
REGION_ROWS = 16_000  # donors that a region should hold
TASK_ROWS = 250_000  # rows that a task deals to regions
REGION_SAMPLE = 32  # fewest sampled donors of a region
BLOCK = 256  # donors that are met at once
SLACK = 1 + 1e-9  # on bounds, for the last bit of sums


def known(f: str) -> Column:
    return F.col(f).isNotNull() & ~F.isnan(F.col(f))


def presence(cols: Sequence[str]) -> Column:
    """Presence bitmask over ``cols`` (bit i set when cols[i] is known)."""
    if len(cols) > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features, got {len(cols)}")
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(known(c), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
                                                for i, c in enumerate(cols)])


def _squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        out += (q[:, j, None] - x[None, :, j]) ** 2
    return out


def _outside(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(q), len(lo)))
    for j in range(q.shape[1]):
        at = q[:, j, None]
        out += np.maximum(np.maximum(lo[None, :, j] - at, at - hi[None, :, j]), 0.0) ** 2
    return out


def _together(labels: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(label, where it occurs) for every label."""
    order = np.argsort(labels, kind="stable")
    found, starts = np.unique(labels[order], return_index=True)
    return zip(found.tolist(), np.split(order, starts[1:]))


def _cut(along: np.ndarray) -> float:
    """A value with points below and points not below it."""
    cut = float(np.median(along))
    return cut if cut > along.min() else float(along[along > along.min()].min())


class _Regions:
    """Regions of a group's space, from a sample of its donors; each sampled row stands for ``per``."""

    def __init__(self, sample: np.ndarray, per: float):
        d = sample.shape[1]
        self.nodes: list[list] = []
        lo, hi, self.near, parts = [], [], [], []
        todo = [(sample, np.full(d, -np.inf), np.full(d, np.inf), None)]
        while todo:
            x, low, high, above = todo.pop()
            if above:
                self.nodes[above[0]][above[1]] = len(self.nodes)
            spread = x.max(0) - x.min(0) if len(x) else np.zeros(d)
            axis = int(np.argmax(spread))
            if len(x) * per <= REGION_ROWS or len(x) < 2 * REGION_SAMPLE or not spread[axis] > 0:
                self.nodes.append([-1, 0.0, len(lo), 0])
                lo.append(low)
                hi.append(high)
                self.near.append(x[::max(1, len(x) // BLOCK)])
                parts.append(1 if spread[axis] > 0 else max(1, math.ceil(len(x) * per / (8 * REGION_ROWS))))
                continue
            cut = _cut(x[:, axis])
            left, upto, since = x[:, axis] < cut, high.copy(), low.copy()
            upto[axis] = since[axis] = cut
            self.nodes.append([axis, cut, 0, 0])
            todo += [(x[left], low, upto, (len(self.nodes) - 1, 2)), (x[~left], since, high, (len(self.nodes) - 1, 3))]
        self.lo, self.hi, self.parts = np.array(lo), np.array(hi), np.array(parts)
        self.first = np.cumsum(self.parts) - self.parts
        self.size = int(self.parts.sum())

    def _home(self, x: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            axis, cut, left, right = self.nodes[node]
            if axis < 0:
                out[rows] = left
                continue
            low = x[rows, axis] < cut
            todo += [(child, part) for child, part in ((left, rows[low]), (right, rows[~low])) if len(part)]
        return out

    def _reached(self, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, region) of all boxes within the points' bounds (squared)."""
        found, todo = [(np.zeros(0, np.int64),) * 2], [(0, np.arange(len(q)))]
        while todo:
            node, rows = todo.pop()
            axis, cut, left, right = self.nodes[node]
            if axis < 0:
                rows = rows[_outside(q[rows], self.lo[left:left + 1], self.hi[left:left + 1])[:, 0] <= bound[rows]]
                found.append((rows, np.full(len(rows), left)))
                continue
            beyond = q[rows, axis] - cut
            near = beyond ** 2 <= bound[rows]
            todo += [(child, part) for child, part in ((left, rows[near | (beyond < 0)]), (right, rows[near | (beyond >= 0)])) if len(part)]
        rows, regions = (np.concatenate(v) for v in zip(*found))
        return rows, regions

    def of_donors(self, x: np.ndarray, digest: np.ndarray) -> np.ndarray:
        home = self._home(x)
        return self.first[home] + digest % self.parts[home]

    def of_receivers(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(receiver, region) of all regions that may hold one of its k nearest, and the
        receivers' bounds (squared)."""
        bound = np.full(len(q), np.inf)
        for region, rows in _together(self._home(q)):
            if len(self.near[region]) >= k:
                bound[rows] = np.partition(_squares(q[rows], self.near[region]), k - 1, axis=1)[:, k - 1] * SLACK
        rows, regions = self._reached(q, bound)
        times = self.parts[regions]
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(rows, times), np.repeat(self.first[regions], times) + nth, bound


class Space:
    """The groups of a search and their regions, numbered through."""

    def __init__(self, feats: Sequence[str], masks: Sequence[int], targets: Sequence[int], sample: np.ndarray, per: float):
        """``masks``: the presence patterns of receivers and donors; ``targets``: the
        features to look for; ``sample``: rows with NaN for what is missing, each
        standing for ``per``."""
        self.feats, nf = list(feats), len(feats)
        seen = _presence(sample)
        self.groups: list[tuple[int, np.ndarray, float]] = []  # target, features, scale of squares
        self.regions: list[_Regions] = []
        self.donors: dict[tuple[int, int], list[int]] = {}  # (target, D) -> groups
        self.receivers: dict[tuple[int, int], list[int]] = {}  # (target, R) -> groups
        numbers: dict[tuple[int, int, int], int] = {}
        for t in targets:
            for r in masks:
                for d in masks:
                    s = r & d
                    if r >> t & 1 or not d >> t & 1 or not s:
                        continue
                    if (t, d, s) not in numbers:
                        dims = np.flatnonzero([s >> i & 1 for i in range(nf)])
                        numbers[t, d, s] = len(self.groups)
                        self.groups.append((t, dims, nf / len(dims)))
                        self.regions.append(_Regions(sample[seen == d][:, dims], per))
                        self.donors.setdefault((t, d), []).append(numbers[t, d, s])
                    self.receivers.setdefault((t, r), []).append(numbers[t, d, s])
        sizes = np.array([g.size for g in self.regions], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.size = int(sizes.sum())

    def group(self, region: int) -> tuple[int, np.ndarray, float]:
        return self.groups[int(np.searchsorted(self.first, region, "right")) - 1]


def _presence(x: np.ndarray) -> np.ndarray:
    return (~np.isnan(x)).astype(np.int64) @ (1 << np.arange(x.shape[1], dtype=np.int64))


def _numbers(batch: pa.RecordBatch | pa.Table, names: Sequence[str]) -> np.ndarray:
    """Columns as one array of doubles, NaN for null."""
    cols = [np.asarray(batch.column(c).cast(pa.float64()).fill_null(math.nan), float) for c in names]
    return np.column_stack(cols) if cols and batch.num_rows else np.empty((batch.num_rows, len(names)))


def sampled(rows: DataFrame, feats: Sequence[str], n: int) -> tuple[np.ndarray, float]:
    """At most about SAMPLE_ROWS rows' features, and how many rows each stands for."""
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    some = rows.select(*feats)
    got = _numbers((some if share == 1.0 else some.sample(share, seed=42)).toArrow().combine_chunks(), feats)
    return got, n / max(len(got), 1)


def dealt_donors(rows: DataFrame, key: str, space: Broadcast, feats: Sequence[str]) -> DataFrame:
    """``region, did, tv, x0..``: every row once per group that it gives a value to."""
    names = [f"x{i}" for i in range(len(feats))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = space.value
        for batch in batches:
            x, digest = _numbers(batch, feats), np.asarray(batch.column("_h")) & (2**62 - 1)
            for mask, rows in _together(_presence(x)):
                for (t, d), groups in at.donors.items():
                    for g in groups if d == mask else ():
                        dims = at.groups[g][1]
                        region = at.first[g] + at.regions[g].of_donors(x[rows][:, dims], digest[rows])
                        some = np.full((len(rows), len(feats)), math.nan)
                        some[:, dims] = x[rows][:, dims]
                        yield pa.RecordBatch.from_arrays([pa.array(region), batch.column("did").take(pa.array(rows)), pa.array(x[rows, t]),
                                                          *[pa.array(np.ascontiguousarray(c)) for c in some.T]], ["region", "did", "tv", *names])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("did"), *feats, F.xxhash64(key).alias("_h")).mapInArrow(
        run, f"region long, did {kind}, tv double, " + ", ".join(f"{c} double" for c in names))


def dealt_receivers(rows: DataFrame, rids: dict[int, str], space: Broadcast, feats: Sequence[str], k: int) -> DataFrame:
    """``region, rid, target, bound, r0..``: every row once per target that it misses and
    region that may hold one of its k nearest donors; ``rids``: its name per target."""
    names = [f"r{i}" for i in range(len(feats))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = space.value
        for batch in batches:
            x = _numbers(batch, feats)
            for mask, rows in _together(_presence(x)):
                for (t, r), groups in at.receivers.items():
                    for g in groups if r == mask else ():
                        some, region, bound = at.regions[g].of_receivers(x[rows][:, at.groups[g][1]], k)
                        which = rows[some]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(at.first[g] + region), batch.column(f"rid{t}").take(pa.array(which)), pa.array(np.full(len(which), t, np.int32)),
                             pa.array(bound[some]), *[pa.array(np.ascontiguousarray(c)) for c in x[which].T]], ["region", "rid", "target", "bound", *names])

    kind = rows.schema[next(iter(rids.values()))].dataType.simpleString()
    return rows.select(*feats, *[F.col(c).alias(f"rid{t}") for t, c in rids.items()]).mapInArrow(
        run, f"region long, rid {kind}, target int, bound double, " + ", ".join(f"{c} double" for c in names))


def _blocks(x: np.ndarray) -> list[np.ndarray]:
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        part = x[rows]
        spread = part.max(0) - part.min(0)
        axis = int(np.argmax(spread))
        if len(rows) <= BLOCK or not spread[axis] > 0:
            out.append(rows)
            continue
        low = part[:, axis] < _cut(part[:, axis])
        todo += [rows[low], rows[~low]]
    return out


class Donors:
    """Donors by blocks: block i is ``x[start[i]:start[i + 1]]``; ties go to the lowest rank."""

    def __init__(self, x: np.ndarray, rank: np.ndarray, start: np.ndarray):
        self.x, self.rank, self.start = x, rank, start
        self.lo, self.hi = (f.reduceat(x, start[:-1], axis=0) if len(x) else x for f in (np.minimum, np.maximum))

    @classmethod
    def of(cls, x: np.ndarray, rank: np.ndarray, k: int) -> tuple[Donors, np.ndarray]:
        """The donors in blocks, and where each was; of equal donors the k first are kept."""
        order = np.lexsort((rank, *x.T))
        new = np.r_[True, (np.diff(x[order], axis=0) != 0).any(1)][:len(x)]
        start = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
        kept = order[np.arange(len(x)) - start < k]
        blocks = _blocks(x[kept]) if len(kept) else []
        kept = kept[np.concatenate(blocks)] if blocks else kept
        return cls(x[kept], rank[kept], np.cumsum([0, *map(len, blocks)])), kept

    def nearest(self, q: np.ndarray, bound: np.ndarray, scale: float, k: int) -> tuple[np.ndarray, ...]:
        """(receiver, donor, distance) of each receiver's k nearest donors within its bound
        (squared), by receiver, distance and rank."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for a in range(0, len(q) if len(self.x) else 0, 8192):
            some, most, found = q[a:a + 8192], bound[a:a + 8192].copy(), []
            apart = _outside(some, self.lo, self.hi)
            for b, rows in _together(apart.argmin(1)):
                since, upto = self.start[b], self.start[b + 1]
                if upto - since >= k:
                    kth = np.partition(_squares(some[rows], self.x[since:upto]), k - 1, axis=1)[:, k - 1] * SLACK
                    most[rows] = np.minimum(most[rows], kth)
            met = apart <= most[:, None]
            for b in np.flatnonzero(met.any(0)).tolist():
                rows, since = np.flatnonzero(met[:, b]), self.start[b]
                ss = _squares(some[rows], self.x[since:self.start[b + 1]])
                i, j = np.nonzero(ss <= most[rows, None])
                found.append((rows[i], since + j, np.sqrt(scale * ss[i, j])))
            if found:
                who, donor, dist = (np.concatenate(v) for v in zip(*found))
                top = first_of_each(who, (self.rank[donor], dist), k)
                out.append((who[top] + a, donor[top], dist[top]))
        who, donor, dist = (np.concatenate(v) for v in zip(*out))
        return who, donor, dist


def first_of_each(who: np.ndarray, by: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    """Where the k first of every ``who`` are, in order; ``by``: the last one counts first."""
    order = np.lexsort((*by, who))
    at = np.arange(len(who)) - np.searchsorted(who[order], who[order])
    return order[at < k]


def means(who: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every ``who`` (ascending) and the mean of its values, added in their order."""
    names, first, n = np.unique(who, return_index=True, return_counts=True)
    total = np.zeros(len(names))
    for j in range(int(n.max(initial=0))):
        more = n > j
        total[more] += values[first[more] + j]
    return names, total / n


def _nearest(x: np.ndarray, rank: np.ndarray, q: np.ndarray, bound: np.ndarray, scale: float, k: int) -> tuple[np.ndarray, ...]:
    """(receiver, donor, distance) of each receiver's k nearest donors within its bound, by
    receiver, distance and rank."""
    donors, kept = Donors.of(x, rank, k)
    who, donor, dist = donors.nearest(q, bound, scale, k)
    return who, kept[donor], dist


def search(donors: DataFrame, receivers: DataFrame, space: Broadcast, k: int, pooled: bool = False) -> DataFrame:
    """``rid, target, r0.., value``: the mean over the k nearest donors of every receiver that
    has one at a defined distance; ties go to the smallest key.  ``pooled``: receivers of one
    rid share the k nearest pairs of them all."""
    size, nf = space.value.size, len(space.value.feats)
    names = [f"r{i}" for i in range(nf)]
    did = donors.schema["did"].dataType
    best = T.ArrayType(T.StructType([T.StructField("dist", T.DoubleType()), T.StructField("did", did), T.StructField("tv", T.DoubleType())]))
    kind = T.StructType([receivers.schema["rid"], T.StructField("target", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in names],
                         T.StructField("best", best)])

    def run(region: tuple, given: pa.Table, asked: pa.Table) -> pa.Table:
        _, dims, scale = space.value.group(region[0].as_py())
        cols = ["rid", "target", *names]
        who = donor = np.zeros(0, np.int64)
        dist, back = np.zeros(0), np.zeros(asked.num_rows, np.int64)
        if given.num_rows and asked.num_rows:
            x, q = _numbers(given, [f"x{i}" for i in dims]), _numbers(asked, [f"r{i}" for i in dims])
            order = np.asarray(pc.sort_indices(given.column("did"), null_placement="at_start"))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            points, at, back = np.unique(q, axis=0, return_index=True, return_inverse=True)
            back = back.reshape(-1)
            who, donor, dist = _nearest(x, rank, points, np.asarray(asked.column("bound"), float)[at], scale, k)
        start, end = np.searchsorted(who, back), np.searchsorted(who, back, "right")
        rows = np.flatnonzero(end > start)
        n = (end - start)[rows]
        ends = np.cumsum(n)
        pick = np.arange(int(n.sum())) - np.repeat(ends - n, n) + np.repeat(start[rows], n)
        at = pa.array(donor[pick])
        values = pa.StructArray.from_arrays([pa.array(dist[pick]), given.column("did").take(at).combine_chunks(), given.column("tv").take(at).combine_chunks()],
                                            ["dist", "did", "tv"])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), values)
        return asked.select(cols).take(pa.array(rows)).append_column("best", lists)

    # A region or a few to a task: what a task holds does not grow with the table.
    tasks = max(int(donors.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // 4)
    found = (donors.repartition(tasks, "region").groupBy("region")
             .cogroup(receivers.repartition(tasks, "region").groupBy("region")).applyInArrow(run, kind))
    total = F.aggregate(F.col("best"), F.lit(0.0), lambda a, b: a + b["tv"])
    best = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
    if not pooled:
        return found.groupBy("rid", "target", *names).agg(best).select("rid", "target", *names, (total / F.size("best")).alias("value"))
    merged = found.groupBy("rid", "target").agg(best, F.collect_set(F.struct(*names)).alias("rows"))
    return merged.select("rid", "target", (total / F.size("best")).alias("value"), F.inline("rows"))


# --- donors of which most stay as they are ---------------------------------------------

def packed(rows: DataFrame, key: str, space: Broadcast, feats: Sequence[str], k: int) -> DataFrame:
    """``region, did[], tv[], start[], x[]``: the donors of every region of a space with one
    group, in blocks."""
    dealt = dealt_donors(rows, key, space, feats)
    did = dealt.schema["did"].dataType.simpleString()
    target, dims, _ = space.value.groups[0]

    def run(region: tuple, given: pa.Table) -> pa.Table:
        order = np.asarray(pc.sort_indices(given.column("did"), null_placement="at_start"))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        donors, kept = Donors.of(_numbers(given, [f"x{i}" for i in dims]), rank, k)
        whole = [given.column("did").take(pa.array(kept)).combine_chunks(), given.column("tv").take(pa.array(kept)).combine_chunks(),
                 pa.array(donors.start), pa.array(donors.x.T.ravel())]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.chunk(0) if isinstance(v, pa.ChunkedArray) else v) for v in whole]
        return pa.table([pa.array([region[0].as_py()]), *lists], ["region", "did", "tv", "start", "x"])

    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), space.value.size // 4)
    return dealt.repartition(tasks, "region").groupBy("region").applyInArrow(
        run, f"region long, did array<{did}>, tv array<double>, start array<long>, x array<double>")


def search_packed(index: DataFrame, rows: DataFrame, key: str, name: str, missing: str, space: Broadcast, feats: Sequence[str],
                  k: int) -> DataFrame:
    """``name, value, best``: the mean over the k nearest donors, among ``index`` and the
    ``rows`` that are not ``missing``, of every row that is; ``best`` (distance, did, tv) in
    its place if the row has donors in several regions."""
    target, dims, scale = space.value.groups[0]
    others, names = [feats[i] for i in dims], [f"x{i}" for i in range(len(dims))]
    kind, who = rows.schema[key].dataType.simpleString(), rows.schema[name].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regions = space.value.regions[0]
        for batch in batches:
            x, tv = _numbers(batch, others), _numbers(batch, [feats[target]])[:, 0]
            known, asks = ~np.isnan(x).any(1), np.asarray(batch.column("_asks").to_pylist(), bool)
            digest = np.asarray(batch.column("_h")) & (2**62 - 1)
            a, b = np.flatnonzero(known & asks), np.flatnonzero(known & ~asks & ~np.isnan(tv))
            some, region, bound = regions.of_receivers(x[a], k)
            at = np.r_[a[some], b]
            alone = np.r_[np.bincount(some, minlength=len(a))[some] == 1, np.zeros(len(b), bool)]
            gives = np.r_[np.zeros(len(some), bool), np.ones(len(b), bool)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[region, regions.of_donors(x[b], digest[b])]), batch.column("_name").take(pa.array(at)), batch.column("_did").take(pa.array(at)),
                 pa.array(gives), pa.array(alone), pa.array(np.r_[bound[some], np.zeros(len(b))]), pa.array(tv[at]),
                 *[pa.array(np.ascontiguousarray(c)) for c in x[at].T]], ["region", name, "did", "gives", "alone", "bound", "tv", *names])

    def run(region: tuple, given: pa.Table, dealt: pa.Table) -> pa.Table:
        moving, asked = dealt.filter(dealt.column("gives")), dealt.filter(pc.invert(dealt.column("gives")))
        did, tv, x, start = moving.column("did"), np.asarray(moving.column("tv"), float), np.zeros((0, len(dims))), np.zeros(1, np.int64)
        if given.num_rows:
            at = {c: given.column(c).combine_chunks().flatten() for c in ("did", "tv", "start", "x")}
            did = pa.chunked_array([*(at["did"].chunks if isinstance(at["did"], pa.ChunkedArray) else [at["did"]]), *did.chunks])
            tv, start = np.r_[np.asarray(at["tv"], float), tv], np.asarray(at["start"])
            x = np.ascontiguousarray(np.asarray(at["x"], float).reshape(len(dims), -1).T)
        order = np.asarray(pc.sort_indices(did, null_placement="at_start"))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        points, one, back = np.unique(_numbers(asked, names), axis=0, return_index=True, return_inverse=True)
        bound = np.asarray(asked.column("bound"), float)[one]
        who, donor, dist = Donors(x, rank[:len(x)], start).nearest(points, bound, scale, k)
        last = np.flatnonzero(np.arange(len(who)) - np.searchsorted(who, who) == k - 1)
        bound[who[last]] = np.minimum(bound[who[last]], dist[last] ** 2 / scale * SLACK)
        newer, kept = Donors.of(_numbers(moving, names), rank[len(x):], k)
        more = newer.nearest(points, bound, scale, k)
        who, donor, dist = np.r_[who, more[0]], np.r_[donor, len(x) + kept[more[1]]], np.r_[dist, more[2]]
        top = first_of_each(who, (rank[donor], dist), k)
        who, donor, dist = who[top], donor[top], dist[top]
        value = np.full(len(points), math.nan)
        value[np.unique(who)] = means(who, tv[donor])[1]
        back = back.reshape(-1)
        first, end = np.searchsorted(who, back), np.searchsorted(who, back, "right")
        met, alone = end > first, np.asarray(asked.column("alone"), bool)
        n = np.where(met & ~alone, end - first, 0)[met]
        ends = np.cumsum(n)
        pick = np.arange(int(n.sum())) - np.repeat(ends - n, n) + np.repeat(first[met], n)
        best = pa.StructArray.from_arrays([pa.array(dist[pick]), did.take(pa.array(donor[pick])).combine_chunks(), pa.array(tv[donor[pick]])], ["dist", "did", "tv"])
        return pa.table([asked.column(name).filter(pa.array(met)), pa.array(value[back][met], mask=~alone[met]),
                         pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), best)], [name, "value", "best"])

    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), space.value.size // 4)
    dealt = rows.select(F.col(name).alias("_name"), F.col(key).alias("_did"), *feats, F.col(missing).alias("_asks"), F.xxhash64(key).alias("_h")).mapInArrow(
        deal, f"region long, {name} {who}, did {kind}, gives boolean, alone boolean, bound double, tv double, " + ", ".join(f"{c} double" for c in names))
    return index.repartition(tasks, "region").groupBy("region").cogroup(dealt.repartition(tasks, "region").groupBy("region")).applyInArrow(
        run, f"{name} {who}, value double, best array<struct<dist double, did {kind}, tv double>>")
