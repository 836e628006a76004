"""Embedding whitening by polarisation covariance (operator 12).

Entries become whole numbers x = floor(scale * entry) + offset, so every sum
below is exact and does not depend on the order of rows, tasks or retries.

1. Count and sum: n and S per dimension (one grouped pass, partial sums).
2. Polarisation: with the centred value y = x - round(S / n), each task adds up
   the squares of y_i and of y_i + y_j for every dimension and pair of
   dimensions, a cache-sized block of rows at a time.  Each square sum gives a
   variance, and cov(i, j) = (var(i + j) - var(i) - var(j)) / 2; what rounding the
   mean left over is put right in whole numbers.
3. The covariance matrix (dimensions squared, independent of the row count) goes
   to the driver for ``eigh``.
4. Rows are projected and scaled in place.

Square sums travel as LIMBS limbs of 32 bits, one row per task and dimension, and
are merged in a stream, so no task holds more than the matrix.  Entries that are
too large for 64-bit square sums are added as Python integers, also exactly.

Null vectors and vectors with a null or non-finite entry are dropped.  The
dimension is the most frequent length of the rest (the larger on a tie), empty
vectors aside; vectors of other lengths have no place in one matrix and are
dropped too.  x saturates at +-2**61.  Repeated rows and null ids count like any
other.  A component whose eigenvalue is zero to double precision (fewer vectors
than dimensions, constant vectors) has no direction: its rows have whitened =
null, and identity_error is over the other components.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE, OFFSET, COMPONENTS = 1024, 100000, 8
LIMBS = 6
BLOCK = 1024  # rows whose squares are added at once
SMALL_ENTRY = 1 << 25  # BLOCK * (2 * SMALL_ENTRY)**2 < 2**63
SATURATED = 1 << 61
FRACTION = 30  # bits after the point of summed whitened values


@dataclass(frozen=True)
class Whitening:
    """What the fit leaves: all of it as large as the matrix at most."""
    n: int
    sums: list[int]
    scale: int
    offset: int
    values: np.ndarray  # falling eigenvalues
    vectors: np.ndarray  # one column per component, largest entry positive
    explained: np.ndarray
    covariance: np.ndarray

    @property
    def determined(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        floor = self.values[0] * len(self.sums) * np.finfo(float).eps if len(self.values) else 0.0
        return self.values > max(floor, 0.0)


def whole_vectors(rows: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """Rows whose vector can be whitened, and the dimension."""
    v = F.col(f"`{column}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    sizes = usable.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = top["d"] if top else 0
    return usable.filter(F.size(v) == d), d


def whole_numbers(column: pa.Array, d: int, scale: int, offset: int) -> np.ndarray:
    """floor(scale * entry) + offset of an Arrow list column, one row per vector."""
    entries = np.asarray(column.flatten().cast(pa.float64())).reshape(-1, d)
    x = np.floor(scale * entries)
    return np.clip(x, -float(SATURATED), float(SATURATED)).astype(np.int64) + offset


def limbs(value: int) -> list[int]:
    """``value`` in base 2**32, lowest first; the last limb carries the sign."""
    return [(value >> 32 * k) & 0xFFFFFFFF for k in range(LIMBS - 1)] + [value >> 32 * (LIMBS - 1)]


def from_limbs(parts) -> int:
    return sum(int(p) << 32 * k for k, p in enumerate(parts))


def _squares(y: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` (Python integers) the square sums of y_i + y_j, j > i, and of
    y_i at (i, i)."""
    d = y.shape[1]
    for a in range(0, len(y), BLOCK):
        block = np.ascontiguousarray(y[a:a + BLOCK].T)
        if len(block) and max(int(block.max()), -int(block.min())) >= SMALL_ENTRY:
            block = block.astype(object)
        for i in range(d):
            pair = block[i:] + block[i]
            pair[0] = block[i]
            if pair.dtype == object:
                total[i, i:] += (pair * pair).sum(1)
            else:
                total[i, i:] += np.einsum("ij,ij->i", pair, pair).astype(object)


def _totals(d: int, means: list[int], scale: int, offset: int):
    centre = np.array(means, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d), object), False
        for batch in batches:
            if batch.num_rows:
                seen = True
                _squares(whole_numbers(batch.column(0), d, scale, offset) - centre, total)
        if seen:
            for i in range(d):
                flat = [limb for j in range(i, d) for limb in limbs(int(total[i, j]))]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([flat], pa.list_(pa.int64()))], ["i", "limbs"])
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, flat in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.asarray(flat.values)
            held[i] = held[i] + part if i in held else part.copy()
    for i, flat in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([flat], pa.list_(pa.int64()))], ["i", "limbs"])


def _sums(rows: DataFrame, column: str, d: int, scale: int, offset: int) -> tuple[int, list[int]]:
    """n and the exact sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = whole_numbers(batch.column(0), d, scale, offset)
            n += len(x)
            total += (x >> 31).sum(0).astype(object) * (1 << 31) + (x & 0x7FFFFFFF).sum(0).astype(object)
        if n:
            flat = [limb for t in total for limb in limbs(int(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(flat), pa.int64()), pa.array(range(len(flat)), pa.int32()), pa.array(flat, pa.int64())],
                ["n", "at", "limb"])

    parts = rows.select(F.col(f"`{column}`").alias("v")).mapInArrow(run, "n long, at int, limb long")
    got = {r["at"]: (r["n"], r["limb"]) for r in parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("limb").alias("limb")).collect()}
    if not got:
        return 0, [0] * d
    return got[0][0], [from_limbs(got[i * LIMBS + k][1] for k in range(LIMBS)) for i in range(d)]


def fit(rows: DataFrame, column: str, d: int, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """Covariance and components of all ``rows`` (of :func:`whole_vectors`)."""
    n, sums = _sums(rows, column, d, scale, offset)
    means = [(2 * s + n) // (2 * n) for s in sums] if n else sums
    vectors = rows.select(F.col(f"`{column}`").alias("v"))
    parts = vectors.mapInArrow(_totals(d, means, scale, offset), "i int, limbs array<long>")
    square = np.zeros((d, d), object)
    for r in parts.repartition("i").mapInArrow(_merged, "i int, limbs array<long>").collect():
        for k, j in enumerate(range(r["i"], d)):
            square[r["i"], j] = from_limbs(r["limbs"][k * LIMBS:(k + 1) * LIMBS])
    rest = [s - n * m for s, m in zip(sums, means)]  # sum of y
    cov = np.zeros((d, d))
    if n:
        # n**2 times the variance of y_i, and of y_i + y_j
        one = [n * square[i, i] - rest[i] ** 2 for i in range(d)]
        for i in range(d):
            cov[i, i] = float(Fraction(one[i], n * n))
            for j in range(i + 1, d):
                both = n * square[i, j] - (rest[i] + rest[j]) ** 2
                cov[i, j] = cov[j, i] = float(Fraction(both - one[i] - one[j], 2 * n * n))
    values, axes = np.linalg.eigh(cov) if d else (np.empty(0), np.empty((0, 0)))
    k = min(components, d)
    values, axes = np.maximum(values[::-1][:k], 0.0), axes[:, ::-1][:, :k]
    if d:
        axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    trace = float(np.trace(cov))
    return Whitening(n, sums, scale, offset, values, axes, values / trace if trace > 0 else np.zeros(k), cov)


def _projection(model: Whitening):
    """(whole numbers) -> whitened values, and exact squared deviations n*x - S."""
    n, d = model.n, len(model.sums)
    means = [(2 * s + n) // (2 * n) for s in model.sums]
    centre = np.array(means, np.int64)
    rest = [s - n * m for s, m in zip(model.sums, means)]
    shift = np.array([float(Fraction(r, n)) for r in rest])
    scaled = model.vectors / np.sqrt(np.where(model.determined, model.values, 1.0))

    def whitened(x: np.ndarray) -> np.ndarray:
        # row by row (einsum, not a matrix product): a value does not depend on its batch
        return np.einsum("ij,jk->ik", (x - centre) - shift, scaled)

    def deviation(x: np.ndarray) -> list[int | None]:
        y = x - centre
        bound = (n * max(int(np.abs(y).max()), 1) + max(abs(r) for r in rest)) if len(y) else 0
        if bound ** 2 * d < 1 << 63:
            z = y * n - np.array(rest, np.int64)
            return np.einsum("ij,ij->i", z, z).tolist()
        z = y.astype(object) * n - np.array(rest, object)
        return [int(t) if t < 1 << 63 else None for t in (z * z).sum(1)]
    return whitened, deviation


def _exact_sum(whole: np.ndarray) -> np.ndarray:
    """Column sums, as Python integers, of doubles that are whole numbers."""
    if len(whole) and np.abs(whole).max() >= 2.0**62:
        return np.array([sum(int(v) for v in c) for c in whole.T.tolist()], object)
    x = whole.astype(np.int64)
    return (x >> 31).sum(0).astype(object) * (1 << 31) + (x & 0x7FFFFFFF).sum(0).astype(object)


def identity_error(rows: DataFrame, column: str, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity.

    The whitened values are added up as whole multiples of 2**-30, so the figure
    does not depend on how the rows are dealt out.
    """
    k, d = len(model.values), len(model.sums)
    if not model.n or not model.determined.any():
        return 0.0
    whitened, _ = _projection(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k), object)
        for batch in batches:
            w = whitened(whole_numbers(batch.column(0), d, model.scale, model.offset))
            for part, values in ((total[0], w), *((total[1 + i], w * w[:, i:i + 1]) for i in range(k))):
                part += _exact_sum(np.rint(np.ldexp(values, FRACTION)))
        flat = [limb for t in total.reshape(-1) for limb in limbs(int(t))]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat, pa.int64())], ["at", "limb"])

    parts = rows.select(F.col(f"`{column}`").alias("v")).mapInArrow(run, "at int, limb long")
    got = {r["at"]: r["limb"] for r in parts.groupBy("at").agg(F.sum("limb").alias("limb")).collect()}
    flat = [float(Fraction(from_limbs(got[i * LIMBS + j] for j in range(LIMBS)), model.n << FRACTION)) for i in range((k + 1) * k)]
    mean, second = np.array(flat[:k]), np.array(flat[k:]).reshape(k, k)
    use = model.determined
    return float(np.abs((second - np.outer(mean, mean) - np.eye(k))[np.ix_(use, use)]).max())


def whiten(rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per usable vector and component: the key, component (from 1), n,
    deviation (sum of (n * x - S)**2, null beyond a long), whitened, explained,
    identity_error."""
    usable, d = whole_vectors(rows, column)
    usable = usable.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{column}`").cast("array<double>").alias("_v"))
    model = fit(usable, "_v", d, components, scale, offset)
    error = identity_error(usable, "_v", model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whitened, deviation = _projection(model)
        for batch in batches:
            x = whole_numbers(batch.column(1), d, model.scale, model.offset)
            w = whitened(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation(x), pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(w.reshape(-1)), k).cast(pa.list_(pa.float64()))],
                ["_key", "deviation", "w"])

    kind = usable.schema["_key"].dataType.simpleString()
    if not k:
        made = usable.select("_key", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("w"))
    else:
        made = usable.mapInArrow(run, f"_key {kind}, deviation long, w array<double>")
    flat = made.select("_key", "deviation", F.posexplode("w").alias("_at", "_w"))

    def per_component(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("_at") + 1)

    return flat.select(
        F.col("_key").alias(key), (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.when(per_component([bool(b) for b in model.determined], "boolean"), F.col("_w")).alias("whitened"),
        per_component([float(e) for e in model.explained], "double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
