"""Exact profiling.

Quantiles are exact with linear interpolation (pandas / DuckDB
``quantile_cont``) and computed without holding a column in one task, by
bracketed selection (:mod:`scoutlab.operators.selection`): a few counting scans
of the columns as they are, no sort.

A profile with so many groups that their brackets have no proven bound takes
another way: (group, column, value) counts, range partitioning and a checkpoint
for stable partition ids, running counts per partition and partition totals (a
two-level prefix sum), and the values whose rank interval covers a wanted rank.
The same ranks drive Kruskal-Wallis, which needs all of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scoutlab.operators.selection import MAX_BRACKETS, held, quantiles
from scoutlab.session import checkpoint_dir

STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


# --- column pickers (P14, P15) ---------------------------------------------

def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema, minus identifiers."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)]


def existing(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected columns that exist, in expected order."""
    have = set(df.columns)
    return [c for c in expected if c in have]


# --- long format -------------------------------------------------------------

def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to ``(by..., column, value DOUBLE)``, nulls
    dropped."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return (df.select(*by, F.inline(pairs))
            .filter(F.col("value").isNotNull()))


def nsjoin(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` that also matches null with null (group keys of
    a per-category profile may be null).  ``<=>`` is still a hash/sort-merge
    join key, so this plans like a plain equi-join."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys]).alias("__R")
    lft = left.alias("__L")
    cond = [F.col(f"__L.{k}").eqNullSafe(F.col(f"__R.__r_{k}")) for k in keys]
    return lft.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


# --- exact quantiles ---------------------------------------------------------

def value_ranks(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their count ``c``, the count of smaller values
    ``before`` and the group size ``n``: ``(by..., column, value, c, before, n)``.
    """
    spark = long.sparkSession
    keys = [*by, "col_name"]
    vc = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    ranged = (vc.repartitionByRange(parts, *keys, "value")
              .withColumn("pid", F.spark_partition_id())
              .checkpoint(eager=True))
    w_local = (Window.partitionBy("pid", *keys).orderBy("value")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("run", F.sum("c").over(w_local))
    totals = ranged.groupBy("pid", *keys).agg(F.sum("c").alias("pt"))
    w_off = Window.partitionBy(*keys).orderBy("pid")
    offsets = (totals
               .withColumn("offset", F.coalesce(F.sum("pt").over(
                   w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("n", F.sum("pt").over(Window.partitionBy(*keys)))
               .drop("pt"))
    # offsets: one row per (partition, group, column); with no group-by that is
    # partitions x columns rows, a proven bound, so it is broadcast
    offsets = offsets if by else F.broadcast(offsets)
    return (nsjoin(local, offsets, ["pid", *keys])
            .select(*keys, "value", "c", (F.col("offset") + F.col("run") - F.col("c")).alias("before"), "n"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), ranks: DataFrame | None = None) -> DataFrame:
    """Exact quantiles ``(by..., column, p, q)`` with linear interpolation."""
    if ranks is None and (found := quantiles(df, cols, probs, by)) is not None:
        rows = [(*group, c, float(p), q) for group, of in found.items() for (c, p), q in of.items() if q is not None]
        kind = T.StructType([*[df.schema[b] for b in by], T.StructField("col_name", T.StringType()),
                             T.StructField("p", T.DoubleType()), T.StructField("q", T.DoubleType())])
        return df.sparkSession.createDataFrame(rows, kind)
    ranks = ranks if ranks is not None else value_ranks(long_values(df, cols, by), by)
    keys = [*by, "col_name"]
    sizes = ranks.select(*keys, "n").distinct()
    # targets: one row per (group, column, p) — groups x columns x probs
    h = F.col("p") * (F.col("n") - 1)
    targets = (sizes.select(*keys, "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
               .select(*keys, "p", F.floor(h).cast("long").alias("lo"),
                       F.ceil(h).cast("long").alias("hi"), (h - F.floor(h)).alias("frac")))
    # targets: columns x probs rows without a group-by (bounded): broadcast, so
    # the ranked values are never gathered per column into one task
    t = (targets if by else F.broadcast(targets)).alias("t")
    v = ranks.alias("v")
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"v.{k}")) for k in keys]
    covers = lambda r: (F.col("v.before") <= r) & (r < F.col("v.before") + F.col("v.c"))
    hit = (t.join(v, cond + [covers(F.col("t.lo")) | covers(F.col("t.hi"))], "inner")
           .select(*[F.col(f"t.{k}").alias(k) for k in keys], "t.p", "t.lo", "t.hi", "t.frac",
                   F.when(covers(F.col("t.lo")), F.col("v.value")).alias("vlo"),
                   F.when(covers(F.col("t.hi")), F.col("v.value")).alias("vhi")))
    return (hit.groupBy(*keys, "p")
            .agg(F.max("vlo").alias("vlo"), F.max("vhi").alias("vhi"), F.first("frac").alias("frac"))
            .select(*keys, "p", (F.col("vlo") + F.col("frac") * (F.col("vhi") - F.col("vlo"))).alias("q")))


def _wide(df: DataFrame, cols: Sequence[str], by: Sequence[str], aggs) -> DataFrame:
    """``(by..., col_name, <aggs>)`` from one aggregate over the columns as they are;
    ``aggs(i, value)`` names the aggregates of a column.  A column without values in a
    group has no row."""
    named = [{"_n": F.count(F.col(c)), **aggs(i, F.col(c).cast("double"))} for i, c in enumerate(cols)]
    one = df.groupBy(*by).agg(*[a.alias(f"_{k}_{i}") for i, of in enumerate(named) for k, a in of.items()])
    rows = [F.struct(F.lit(c).alias("col_name"), *[F.col(f"_{k}_{i}").alias(k) for k in named[i]]) for i, c in enumerate(cols)]
    return one.select(*by, F.inline(F.array(*rows))).filter("_n > 0").drop("_n")


MOMENTS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def _moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, max per (by..., column) in one pass (map-side
    partial aggregation)."""
    return _wide(df, cols, by, lambda i, x: {k: f(x) for k, f in MOMENTS.items()})


def _within(df: DataFrame, cols: Sequence[str], by: Sequence[str], bounds: DataFrame, aggs) -> DataFrame:
    """Aggregates ``aggs(value, lower, upper)`` per (by..., column), each column against its
    own bounds ``(by..., col_name, lower, upper)``.  Without groups the bounds are a row
    per column and become literals; else they are joined, one row per group."""
    ends = ("lower", "upper")
    if not by:
        got = {r["col_name"]: [F.lit(r[e]) for e in ends] for r in bounds.collect()}
        nothing = [F.lit(None).cast("double")] * 2  # a column without values
        return _wide(df, cols, by, lambda i, x: aggs(x, *got.get(cols[i], nothing)))
    flat = bounds.groupBy(*by).agg(*[F.max(F.when(F.col("col_name") == c, F.col(e))).alias(f"_{e}{i}")
                                     for i, c in enumerate(cols) for e in ends])
    joined = nsjoin(df.select(*by, *cols), flat, by)
    return _wide(joined, cols, by, lambda i, x: aggs(x, *[F.col(f"_{e}{i}") for e in ends]))


def _pivot_quantiles(q: DataFrame, probs: Sequence[float], names: Sequence[str],
                     by: Sequence[str] = ()) -> DataFrame:
    return q.groupBy(*by, "col_name").agg(*[
        F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(n) for p, n in zip(probs, names)])


def describe(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """G1: transposed describe — one row per column with count, mean, std,
    min, q25, q50, q75, max (exact quantiles)."""
    cols = list(cols or numeric_columns(df, by))
    probs, names = [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    keys, stats = [*by, "col_name"], ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    with held(df.select(*by, *cols)) as rows:
        found = quantiles(rows, cols, probs, by, extra=MOMENTS)
    if found is not None:
        table = [(*group, c, of[c, "count"], of[c, "mean"], of[c, "std"], of[c, "min"], *[of[c, p] for p in probs], of[c, "max"])
                 for group, of in found.items() for c in cols if of[c, "count"]]
        kind = [*[df.schema[b] for b in by], T.StructField("col_name", T.StringType()), T.StructField("count", T.LongType()),
                *[T.StructField(s, T.DoubleType()) for s in stats[1:]]]
        return df.sparkSession.createDataFrame(table, T.StructType(kind))
    q = _pivot_quantiles(exact_quantiles(df, cols, probs, by), probs, names, by)
    return nsjoin(_moments(df, cols, by), q, keys, "left").select(*keys, *stats)


def describe_short(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean, median, std, min, max."""
    d = describe(df, cols)
    return d.select("col_name", "mean", F.col("q50").alias("median"), "std", "min", "max")


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
                 by: Sequence[str] = ()) -> DataFrame:
    """Tukey fences from exact quartiles; outlier count and percent of
    ALL rows (nulls included in the denominator)."""
    cols = list(cols or numeric_columns(df, by))
    return _while_held(df, cols, by, lambda rows: _iqr_outliers(rows, cols, k, by))


def _while_held(df: DataFrame, cols: Sequence[str], by: Sequence[str], profile) -> DataFrame:
    """``profile`` of the columns, which takes several scans, brought in while its input
    is held; with more rows than MAX_BRACKETS (so many groups) it stays a plan."""
    with held(df.select(*by, *cols)) as rows:
        out = profile(rows)
        got = out.limit(MAX_BRACKETS + 1).collect()
    return df.sparkSession.createDataFrame(got, out.schema) if len(got) <= MAX_BRACKETS else profile(df)


def _iqr_outliers(df: DataFrame, cols: Sequence[str], k: float, by: Sequence[str]) -> DataFrame:
    keys = [*by, "col_name"]
    q = _pivot_quantiles(exact_quantiles(df, cols, [0.25, 0.75], by), [0.25, 0.75], ["q1", "q3"], by)
    bounds = q.select(*keys, "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                      (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
                      (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))
    counted = _within(df, cols, by, bounds, lambda x, low, high: {
        "n_outliers": F.count_if((x < low) | (x > high)), "n_rows": F.count(F.lit(1))})
    res = nsjoin(bounds, counted, keys, "left")
    return res.select(*keys, "q1", "q3", "iqr", "lower", "upper",
                      F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"),
                      F.round(F.try_divide(F.coalesce("n_outliers", F.lit(0)) * 100.0, F.col("n_rows")), 2)
                      .alias("pct_outliers"))


def boxplot_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the most extreme points inside the
    fences, outlier count — per column, optionally per category."""
    return _while_held(df, cols, by, lambda rows: _boxplot_stats(rows, cols, by, k))


def _boxplot_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str], k: float) -> DataFrame:
    keys = [*by, "col_name"]
    q = _pivot_quantiles(exact_quantiles(df, cols, [0.25, 0.5, 0.75], by),
                         [0.25, 0.5, 0.75], ["q1", "median", "q3"], by)
    b = q.select(*keys, "q1", "median", "q3",
                 (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
                 (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))
    agg = _within(df, cols, by, b, lambda x, low, high: {
        "n": F.count(x), "whisker_low": F.min(F.when(x.between(low, high), x)),
        "whisker_high": F.max(F.when(x.between(low, high), x)), "n_outliers": F.count_if(~x.between(low, high))})
    return nsjoin(b, agg, keys).select(*keys, "n", "q1", "median", "q3", "whisker_low", "whisker_high",
                                       "n_outliers")


# --- histograms and density ---------------------------------------------------

def _min_max(df: DataFrame, c: str) -> tuple[float | None, float | None, int]:
    row = df.agg(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi"),
                 F.count(c).alias("n")).first()
    return row["lo"], row["hi"], row["n"]


def histogram(df: DataFrame, c: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram like ``np.histogram``: ``bins`` bins over
    [min, max], the last bin closed on the right; a constant column uses
    [v-0.5, v+0.5].  Every bin is reported (empty ones with 0).  The
    min/max come back as one scalar row; the counting is one distributed
    aggregate keyed by a bounded bin number."""
    spark = df.sparkSession
    lo, hi, _ = _min_max(df, c)
    if lo is None:
        return spark.createDataFrame([], "bin INT, lower DOUBLE, upper DOUBLE, center DOUBLE, count LONG")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    x = F.col(c).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) * F.lit(bins) / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = lambda i: F.lit(lo) + i * F.lit(width)
    return (grid.join(counts, "bin", "left")
            .select("bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
                    F.round(edge(F.col("bin") + 0.5), 2).alias("center"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def _kernel_sums(grids: list[tuple[float, float, float]], grid_points: int):
    """mapInArrow body: per column the sums of the Gaussian kernels of its values on its
    grid (first point, step, bandwidth): one buffer of ``grid_points`` sums a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(grids), grid_points))
        for batch in batches:
            for c, (first, step, h) in enumerate(grids):
                x = np.asarray(batch.column(c).drop_null())
                values, counts = np.unique(x[~np.isnan(x)], return_counts=True)
                points = (first + step * np.arange(grid_points))[:, None]
                for at in range(0, len(values), 2048):
                    part = values[at:at + 2048]
                    sums[c] += np.exp(-0.5 * ((points - part) / h) ** 2) @ counts[at:at + 2048]
        place = np.arange(len(grids) * grid_points)
        yield pa.RecordBatch.from_arrays([pa.array(place // grid_points, pa.int32()), pa.array(place % grid_points, pa.int32()),
                                          pa.array(sums.reshape(-1))], ["c", "i", "s"])
    return run


def kde_curves(df: DataFrame, cols: Sequence[str], grid_points: int = 200, cut: float = 3.0, shared: bool = False) -> DataFrame:
    """Gaussian kernel densities ``(col_name, i, x, density)`` of many columns with
    Scott's bandwidth ``std * n^(-1/5)``, on grids from ``min - cut*h`` to ``max + cut*h``.

    ``shared`` puts all curves on one grid, wide enough for each, as for the original
    and the imputed values of a column.  Two scans: one for counts, extremes and
    deviations, one in which every task adds its kernels up; a task sends
    ``grid_points`` sums a column.  Columns without spread have no curve; nulls and
    NaN are left out."""
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    st = values.agg(*[f(c).alias(f"{n}{c}") for c in values.columns
                      for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count), ("sd", F.stddev_samp))]).first()
    kept, grids = [], []
    for i, c in enumerate(cols):
        lo, hi, n, sd = (st[f"{k}c{i}"] for k in ("lo", "hi", "n", "sd"))
        if n and sd:
            h = sd * n ** (-0.2)
            kept.append((i, c, n, h))
            grids.append((lo - cut * h, hi + cut * h))
    kind = "col_name STRING, i INT, x DOUBLE, density DOUBLE"
    if not kept:
        return df.sparkSession.createDataFrame([], kind)
    if shared:
        grids = [(min(g[0] for g in grids), max(g[1] for g in grids))] * len(grids)
    plan = [(lo, (hi - lo) / (grid_points - 1), h) for (lo, hi), (_, _, _, h) in zip(grids, kept)]
    sums = (values.select(*[f"c{i}" for i, *_ in kept]).mapInArrow(_kernel_sums(plan, grid_points), "c int, i int, s double")
            .groupBy("c", "i").agg(F.sum("s").alias("s")))
    facts = F.array(*[F.struct(F.lit(c).alias("col_name"), F.lit(lo).alias("lo"), F.lit(step).alias("step"),
                               F.lit(1.0 / (n * h * math.sqrt(2 * math.pi))).alias("norm")) for (_, c, n, h), (lo, step, _) in zip(kept, plan)])
    return sums.withColumn("f", F.get(facts, F.col("c"))).select(
        "f.col_name", "i", (F.col("f.lo") + F.col("i") * F.col("f.step")).alias("x"), (F.col("s") * F.col("f.norm")).alias("density"))


def kde_curve(df: DataFrame, c: str, grid_points: int = 200, cut: float = 3.0) -> DataFrame:
    """G8 of one column: ``(i, x, density)``; see :func:`kde_curves`."""
    return kde_curves(df, [c], grid_points, cut).select("i", "x", "density")


def histogram_density(df: DataFrame, c: str, bins: int = 30) -> DataFrame:
    """The histogram of G4 with the density curve on its scale: ``kde`` is the
    expected count of a bin as wide as the histogram's, at the bin's centre."""
    h = histogram(df, c, bins)
    x = F.col(c).cast("double")
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if not st["n"] or not st["sd"]:
        return h.withColumn("kde", F.lit(None).cast("double"))
    width = (st["hi"] - st["lo"]) / bins
    plan = [(st["lo"] + width / 2, width, st["sd"] * st["n"] ** (-0.2))]
    sums = (df.select(x.alias("c0")).mapInArrow(_kernel_sums(plan, bins), "c int, i int, s double")
            .groupBy("i").agg(F.sum("s").alias("s")))
    scale = width / (plan[0][2] * math.sqrt(2 * math.pi))
    return h.join(sums, F.col("bin") == F.col("i"), "left").select(*h.columns, (F.col("s") * scale).alias("kde"))


# --- correlation, regression, skewness ------------------------------------------

def _pair_corr(a: str, b: str) -> Column:
    """Pairwise-complete Pearson r; constant column -> null (no error)."""
    r = F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
    return F.when(~F.isnan(r), r)


def _gram(shift: list[float]):
    """mapInArrow body: per pair of columns i <= j the sums over the rows that have both,
    of values less their column's ``shift``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = np.triu_indices(len(shift))
        total = np.zeros((6, len(i)))
        for batch in batches:
            x = np.column_stack([np.asarray(v.to_numpy(zero_copy_only=False), float) for v in batch.columns]) - shift
            there = ~np.isnan(x)
            y, w = np.where(there, x, 0.0), there.astype(float)
            n, s, q, co = w.T @ w, y.T @ w, (y * y).T @ w, y.T @ y
            total += [n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], co[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, total)], list(_GRAM))
    return run


_GRAM = ("i", "j", "n", "si", "sj", "qi", "qj", "co")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairwise-complete Pearson correlations, returned long as (a, b, r);
    the diagonal is 1, a constant column gives null.  NaN counts as missing.

    One scan: each batch adds its masked Gram blocks (matrix products) to the task's,
    and tasks send one row of sums per pair, whatever the number of rows.  Values are
    taken from their column's minimum, found before, so that large means do not
    cancel."""
    cols = list(cols)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    low = values.agg(*[F.min(F.when(~F.isnan(c), F.col(c))).alias(c) for c in values.columns]).first()
    shift = [0.0 if v is None or math.isinf(v) else v for v in low]
    sums = (values.mapInArrow(_gram(shift), "i int, j int, " + ", ".join(f"{k} double" for k in _GRAM[2:]))
            .groupBy("i", "j").agg(*[F.sum(k).alias(k) for k in _GRAM[2:]]))

    def moment(q: str, a: str, b: str) -> Column:
        return F.col(q) - F.try_divide(F.col(a) * F.col(b), F.col("n"))

    mi, mj = moment("qi", "si", "si"), moment("qj", "sj", "sj")
    varies = (mi > F.col("qi") * 1e-13) & (mj > F.col("qj") * 1e-13)
    r = F.when(varies, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(moment("co", "si", "sj") / (F.sqrt(mi) * F.sqrt(mj))))
    names = F.array(*[F.lit(c) for c in cols])
    one = sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("r"))
    both = F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    return one.select(F.inline(F.when(F.col("a") == F.col("b"), F.slice(both, 1, 1)).otherwise(both)))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, sorted descending."""
    one = df.agg(*[_pair_corr(c, target).alias(f"p{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("col_name"), F.col(f"p{i}").alias("r")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*entries)))


def top_correlated(df: DataFrame, cols: Sequence[str], target: str, k: int = 3) -> DataFrame:
    """The k columns most correlated with the target (target excluded)."""
    others = [c for c in cols if c != target]
    return (corr_with_target(df, others, target)
            .orderBy(F.col("r").desc_nulls_last(), F.col("col_name")).limit(k))


def regression_line(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """Least-squares line per (x, y) pair, all in one aggregate over one
    scan; constant x -> null."""
    yy = F.col(y).cast("double")
    one = df.agg(*[F.struct(F.lit(x).alias("x"), F.regr_slope(yy, F.col(x).cast("double")).alias("slope"),
                            F.regr_intercept(yy, F.col(x).cast("double")).alias("intercept"),
                            F.regr_r2(yy, F.col(x).cast("double")).alias("r2"),
                            F.regr_count(yy, F.col(x).cast("double")).alias("n")).alias(f"l{i}") for i, x in enumerate(xs)])
    return one.select(F.inline(F.array(*[F.col(f"l{i}") for i in range(len(xs))])))


def seeded_uniform(*parts: Column | str, seed: int) -> Column:
    """A uniform of [0, 1) with 32 bits from the md5 of the parts and the seed
    (an order and a draw that any engine can repeat)."""
    digest = seeded_digest(*parts, seed=seed)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def seeded_digest(*parts: Column | str, seed: int) -> Column:
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *texts, F.lit(str(seed))).cast("binary"))


def poisson_thresholds() -> list[float]:
    """P(X <= k) of a Poisson(1) variable, to where 32 bits cannot tell it from 1."""
    out, term, total = [], math.exp(-1.0), 0.0
    for k in range(1, 14):
        total += term
        out.append(round(total, 12))
        term /= k
    return out


_MD5_SHIFTS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_MD5_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]


def _md5_heads(words: list) -> np.ndarray:
    """The first 32 bits (as the first eight hexadecimal digits) of the md5 of one-block
    messages; ``words``: 16 uint32 arrays that broadcast to one shape.  The digest's
    first word needs 61 of the 64 steps."""
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full((1, 1), x) for x in start)
    for i in range(61):
        turn = i // 16
        if turn == 0:
            f, g = d ^ (b & (c ^ d)), i
        elif turn == 1:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif turn == 2:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f = f + a + (words[g] + np.uint32(_MD5_SINES[i]))
        by = _MD5_SHIFTS[turn][i % 4]
        a, d, c, b = d, c, b, b + ((f << np.uint32(by)) | (f >> np.uint32(32 - by)))
    return (b + start[0]).byteswap()


def _draws(prefixes: list[bytes], suffixes: list[bytes]) -> np.ndarray:
    """32 bits of the md5 of every prefix (of one length) with every suffix (of one length)."""
    before, after = len(prefixes[0]), len(suffixes[0])
    if before + after > 55:  # more than a block
        return np.array([[int(hashlib.md5(p + x).hexdigest()[:8], 16) for x in suffixes] for p in prefixes], np.uint32)
    tail = b"\x80" + bytes(55 - before - after) + (8 * (before + after)).to_bytes(8, "little")
    first = np.frombuffer(b"".join(p + bytes(64 - before) for p in prefixes), "<u4").reshape(-1, 16)
    second = np.frombuffer(b"".join(bytes(before) + x + tail for x in suffixes), "<u4").reshape(-1, 16)
    words = [first[:, w, None] if 4 * w + 4 <= before else second[None, :, w] if 4 * w >= before else first[:, w, None] | second[None, :, w]
             for w in range(16)]
    return np.broadcast_to(_md5_heads(words), (len(prefixes), len(suffixes)))


_BAND = ["sw", "sx", "sy", "sxx", "sxy"]


def _resampled(replicates: int, seed: int):
    """mapInArrow body: per replicate the task's sums, every row (k, x, y) weighed by a
    Poisson(1) draw from the seeded digest of its key and the replicate."""
    cuts = [math.ceil(t * 2**32) for t in poisson_thresholds()]
    runs: dict[int, list[tuple[int, bytes]]] = {}
    for b in range(1, replicates + 1):
        runs.setdefault(len(str(b)), []).append((b - 1, f"{b}:{seed}".encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, lo, hi = np.zeros((replicates, len(_BAND))), math.inf, -math.inf
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.asarray(batch.column(c), float) for c in ("x", "y"))
            values = np.column_stack([np.ones(len(x)), x, y, x * x, x * y])
            lo, hi = min(lo, float(x.min())), max(hi, float(x.max()))
            lengths: dict[int, list[tuple[int, bytes]]] = {}
            for i, k in enumerate(batch.column("k").to_pylist()):
                text = b"" if k is None else f"{k}:".encode()
                lengths.setdefault(len(text), []).append((i, text))
            for rows in lengths.values():
                for at in range(0, len(rows), 16):  # arrays that stay in the cache
                    some = rows[at:at + 16]
                    for reps in runs.values():
                        h = _draws([t for _, t in some], [t for _, t in reps])
                        w = np.zeros(h.shape, np.uint8)
                        for cut in cuts:
                            w += h >= cut
                        sums[reps[0][0]:reps[-1][0] + 1] += w.T.astype(float) @ values[[i for i, _ in some]]
        if lo <= hi:
            out = [np.arange(1, replicates + 1, dtype=np.int32), np.full(replicates, lo), np.full(replicates, hi), *sums.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v)) for v in out], ["b", "lo", "hi", *_BAND])
    return run


def regression_band(df: DataFrame, x: str, y: str, key: str, replicates: int = 1000,
                    seed: int = 42, grid_points: int = 100) -> DataFrame:
    """95 % bootstrap band of the regression line (Poisson bootstrap).

    Each row gets a Poisson(1) weight per replicate from a seeded digest (no
    resampling shuffle); weighted sums per replicate give slope and intercept; the
    band is the 2.5/97.5 % quantile of the fitted value at each grid x.  One scan:
    a task draws the weights of its rows as arrays, rows x ``replicates`` digests in
    all, and sends one row of sums per replicate.  The rows are dealt out first, since a
    row's work is far larger than the row."""
    xx, yy = F.col(x).cast("double"), F.col(y).cast("double")
    base = df.filter(xx.isNotNull() & yy.isNotNull()).select(F.col(key).cast("string").alias("k"), xx.alias("x"), yy.alias("y"))
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    sums = base.repartition(tasks).mapInArrow(_resampled(replicates, seed), "b int, lo double, hi double, " + ", ".join(f"{c} double" for c in _BAND))
    rep = sums.groupBy("b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(c).alias(c) for c in _BAND])
    slope = F.try_divide(F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy"),
                         F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx"))
    fits = rep.select("lo", "hi", slope.alias("m"), F.try_divide(F.col("sy") - slope * F.col("sx"), F.col("sw")).alias("c"))
    gx = F.col("lo") + F.col("i") * ((F.col("hi") - F.col("lo")) / F.lit(max(grid_points - 1, 1)))
    grid = fits.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1)))).withColumn("gx", gx)
    return (grid.select("i", "gx", (F.col("m") * F.col("gx") + F.col("c")).alias("fit"))
            .groupBy("i", "gx").agg(F.percentile("fit", 0.025).alias("lower"),
                                    F.percentile("fit", 0.975).alias("upper")))


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness (pandas ``Series.skew``)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.skewness(x).alias(f"g{i}"), F.count(x).alias(f"n{i}")]
    one = df.agg(*aggs)
    entries = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        adj = F.when(n > 2, F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        entries.append(F.struct(F.lit(c).alias("col_name"), adj.alias("skew")))
    return one.select(F.inline(F.array(*entries)))


# --- nulls and categories ----------------------------------------------------------

def null_report(df: DataFrame, cols: Sequence[str] | None = None, only_with_nulls: bool = True) -> DataFrame:
    """Null count and percent per column (one aggregate, unpivoted)."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("col_name"), F.col(f"z{i}").alias("n_null")) for i, c in enumerate(cols)]
    out = one.select("_n", F.inline(F.array(*entries))).select(
        "col_name", "n_null", F.round(F.try_divide(F.col("n_null") * 100.0, F.col("_n")), 2).alias("pct_null"))
    return out.filter(F.col("n_null") > 0) if only_with_nulls else out


def null_total(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total of remaining nulls over the given columns."""
    return df.agg(sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0)).cast("long").alias("n_null"))


def top_categories(df: DataFrame, c: str, n: int = 15, keep_null_as: str | None = None) -> DataFrame:
    """Category frequencies, top n; nulls excluded or shown as a marker."""
    col = F.coalesce(F.col(c), F.lit(keep_null_as)) if keep_null_as else F.col(c)
    base = df.select(col.alias(c))
    if keep_null_as is None:
        base = base.filter(F.col(c).isNotNull())
    return (base.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(c)).limit(n))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42,
                 required: Sequence[str] = ()) -> DataFrame:
    """Exact-size seeded sample of min(n, rows surviving the null
    drop): rows ordered by a seeded digest of the key (``TakeOrderedAndProject``;
    each task keeps only its n best)."""
    base = df.na.drop(subset=list(required)) if required else df
    return base.orderBy(seeded_digest(key, seed=seed), F.col(key)).limit(n)
