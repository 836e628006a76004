"""Missing-value handling.

KNN imputation (G16) and iterative KNN imputation (G17) share one exact
nearest-neighbour search (:mod:`knn`) that never forms receivers x donors.  Distances are
nan-Euclidean: ``sqrt(|F| / |P| * sum_P (a-b)^2)`` over the features P present in both
rows (plain Euclidean when nothing is missing); ties are broken by the donor key, so
results are deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, Window, functions as F

from scoutlab.functions.scalar import MISSING_MARKER
from scoutlab.operators import knn as N
from scoutlab.operators.profile import exact_quantiles
from scoutlab.session import Shelf, checkpoint_dir


# --- simple imputers -----------------------------------------------------------

def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact medians (one small row per column comes back to the driver)."""
    q = exact_quantiles(df, cols, [0.5]).collect()
    got = {r["col_name"]: r["q"] for r in q}
    return {c: got.get(c) for c in cols}


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls with the exact column median."""
    med = column_medians(df, cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(med[c])).alias(c) if c in med else F.col(c)
                       for c in df.columns])


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column; ties -> smallest value.
    One scan: all columns are melted and counted together, and one value per
    column comes back."""
    melted = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])))
    counts = melted.filter("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    top = counts.withColumn("k", F.row_number().over(Window.partitionBy("c").orderBy(F.col("n").desc(), "v"))).filter("k = 1")
    got = {r["c"]: r["v"] for r in top.collect()}
    return {c: got.get(c) for c in cols}


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill text nulls with the column mode (ties -> smallest)."""
    modes = column_modes(df, cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(modes[c])).alias(c) if c in modes else F.col(c)
                       for c in df.columns])


def impute_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill nulls with a constant per column (e.g. 'Sin Equipo')."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def fill_marker(df: DataFrame, cols: Sequence[str], marker: str = MISSING_MARKER) -> DataFrame:
    """Null text shown as a marker."""
    return impute_constant(df, {c: marker for c in cols})


# --- KNN imputation ---------------------------------------------------------------------

def impute_knn(df: DataFrame, key: str, feats: Sequence[str], k: int = 5) -> DataFrame:
    """KNNImputer(n_neighbors=k) semantics on ``feats`` (unscaled,
    nan-Euclidean, uniform weights); a cell with no donor at a defined
    distance gets the column mean.  Observed cells are never changed.

    The presence patterns that occur and a bounded sample come to the driver."""
    feats = list(feats)
    spark = df.sparkSession
    base = df.select(key, *[F.col(f).cast("double").alias(f) for f in feats])
    means = df.agg(*[F.avg(f).alias(f) for f in feats]).first()
    patterns = {r["m"]: r["n"] for r in base.groupBy(N.presence(feats).alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}
    targets = [i for i in range(len(feats)) if any(not m >> i & 1 for m in patterns) and any(m >> i & 1 for m in patterns)]
    sample, per = N.sampled(base, feats, sum(patterns.values()))
    plan = N.Space(feats, sorted(patterns), targets, sample, per)
    if not plan.groups:
        return df.select(*[F.coalesce(F.col(c), F.lit(means[c])).alias(c) if c in feats else F.col(c) for c in df.columns])
    space = spark.sparkContext.broadcast(plan)
    # A row becomes several donors: the rows of one task are few enough to hold these.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(patterns.values()) // N.TASK_ROWS)
    asking = reduce(lambda a, b: a | b, [~N.known(feats[i]) for i in targets])
    # Receivers with equal features are one query, named by the smallest of their cells.
    asked = base.filter(asking)
    cell = {i: F.concat_ws("|", F.col(key).cast("string"), F.lit(feats[i])) for i in targets}
    queries = asked.groupBy(*feats).agg(*[F.min(cell[i]).alias(f"rid{i}") for i in targets])
    receivers = N.dealt_receivers(queries, {i: f"rid{i}" for i in targets}, space, feats, k)
    found = N.search(N.dealt_donors(base.repartition(tasks), key, space, feats), receivers, space, k, pooled=True)
    rows = asked.select(key, *[F.when(N.known(f), F.col(f)).otherwise(F.lit(float("nan"))).alias(f"r{i}") for i, f in enumerate(feats)])
    filled = rows.join(found, [f"r{i}" for i in range(len(feats))]).groupBy(key).agg(
        *[F.max(F.when(F.col("target") == i, F.col("value"))).alias(f"_v_{feats[i]}") for i in targets])
    out = df.join(filled, key, "left")
    value = {feats[i]: F.col(f"_v_{feats[i]}") for i in targets}
    return out.select(*[F.coalesce(F.col(c), *([value[c]] if c in value else []), F.lit(means[c])).alias(c) if c in feats
                        else F.col(c) for c in df.columns])


# Most bytes of donors that the iterative imputer hands to every task.
DONOR_BYTES = 32 << 20


def _arrays(rows: DataFrame, key: str, feats: list[str]) -> tuple[pa.Array, np.ndarray]:
    table = rows.select(key, *feats).toArrow().combine_chunks()
    return table.column(key).combine_chunks(), np.column_stack([np.asarray(table.column(g), float) for g in feats])


def _prepared(x: np.ndarray, target: np.ndarray, rank: np.ndarray, k: int) -> tuple[N.Donors, np.ndarray]:
    ok = np.flatnonzero(~np.isnan(x).any(1) & ~np.isnan(target))
    donors, kept = N.Donors.of(x[ok], rank[ok], k)
    return donors, target[ok][kept]


def _column(batch: pa.RecordBatch, f: str) -> np.ndarray:
    return np.asarray(batch.column(f), float).copy()


def _filled(given: list[Broadcast], feats: list[str], f: str, k: int, fresh: bool):
    """mapInArrow body: column ``f`` of the rows that miss it, from the broadcast donors."""
    others = [g for g in feats if g != f]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [p.value for p in given]
        target = np.concatenate([t for _, t in parts])
        rank = np.concatenate([p.rank for p, _ in parts])
        first = np.cumsum([0, *(len(t) for _, t in parts)])
        for batch in batches:
            x = np.column_stack([_column(batch, g) for g in others])
            at = np.flatnonzero(np.asarray(batch.column(f"_miss_{f}").to_pylist(), bool) & ~np.isnan(x).any(1))
            points, back = np.unique(x[at], axis=0, return_inverse=True)
            found = [p.nearest(points, np.full(len(points), np.inf), 1.0, k) for p, _ in parts]
            who, dist = (np.concatenate([v[i] for v in found]) for i in (0, 2))
            donor = np.concatenate([a + v[1] for a, v in zip(first, found)])
            top = N.first_of_each(who, (rank[donor], dist), k)
            value = np.full(len(points), np.nan)
            names, value[np.unique(who)] = N.means(who[top], target[donor[top]])
            value, met = value[back.reshape(-1)], np.isin(back.reshape(-1), names)
            new, moved = _column(batch, f), _column(batch, "_moved") * (not fresh)
            moved[at[met]] += np.abs(value[met] - new[at[met]])
            new[at[met]] = value[met]
            for c, v in ((f, new), ("_moved", moved)):
                batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(v))
            yield batch
    return run


def _joined(part: DataFrame, found: DataFrame, f: str, k: int, fresh: bool) -> DataFrame:
    """The rows with the ``value`` or the mean over the k first of all ``best`` that were found
    for them as their ``f``."""
    total = F.aggregate("best", F.lit(0.0), lambda a, b: a + b["tv"])
    values = (found.groupBy("_id").agg(F.max("value").alias("value"), F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
              .select("_id", F.coalesce("value", total / F.size("best")).alias("_value")))
    step = F.coalesce(F.abs(F.col("_value") - F.col(f)), F.lit(0.0))
    return part.join(values, "_id", "left").withColumns(
        {"_moved": step if fresh else F.col("_moved") + step, f: F.coalesce("_value", f)}).select(*part.columns)


def _swept(rows: DataFrame, key: str, feats: list[str], visit: list[str], st: Row, k: int, max_iter: int, tol: float, donor_bytes: int,
           shelf: Shelf) -> DataFrame:
    """``key, _v_<f>..``: the rows with holes after the last sweep."""
    spark = rows.sparkSession
    holes = reduce(lambda a, b: a | b, [F.col(f"_miss_{f}") for f in visit])
    fits = st["n"] * 8 * (len(feats) + 2) <= donor_bytes
    # Regions are cut by donors that stay; where these are few, all rows move.
    stays = fits or 2 * st["whole"] >= st["n"]
    # The rows with holes are searched for in every visit: dealt out evenly once.
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), st["n"] // N.TASK_ROWS)
    whole = rows.filter(~holes if stays else F.lit(False))
    part = (rows.filter(holes if stays else F.lit(True)).repartition(spread)
            .withColumns({"_moved": F.lit(0.0), "_id": F.monotonically_increasing_id()}))
    part = shelf.put(part)
    threshold = tol * float(st["amax"])
    if fits:
        names, fixed = _arrays(whole, key, feats)
        holed = _arrays(part, key, feats)[0]
        order = pc.sort_indices(pa.concat_arrays([names, holed]))
        ranks = np.empty(len(order), np.int64)
        ranks[np.asarray(order)] = np.arange(len(order))
        place = dict(zip(holed.to_pylist(), ranks[len(names):].tolist()))
    index: dict[str, tuple[Broadcast, DataFrame] | Broadcast] = {}

    def visited(part: DataFrame, f: str, fresh: bool) -> DataFrame:
        others = [g for g in feats if g != f]
        given = part.filter(~F.col(f"_miss_{f}"))
        if not others:  # nothing to search by: the mean stays
            return part
        if fits:
            at, rest = feats.index(f), [feats.index(g) for g in others]
            if f not in index:
                index[f] = spark.sparkContext.broadcast(_prepared(fixed[:, rest], fixed[:, at], ranks[:len(names)], k))
            keys, moving = _arrays(given, key, feats)
            moved = np.array([place[v] for v in keys.to_pylist()], np.int64)
            moving = spark.sparkContext.broadcast(_prepared(moving[:, rest], moving[:, at], moved, k))
            return shelf.put(part.mapInArrow(_filled([index[f], moving], feats, f, k, fresh), part.schema), instead=part)
        cols, t = [*others, f], len(others)
        if f not in index or not stays:
            sample, per = N.sampled(whole if stays else given, cols, st["n"] - st[f"z_{f}"])
            full = (1 << len(cols)) - 1
            space = spark.sparkContext.broadcast(N.Space(cols, [full ^ (1 << t), full], [t], sample, per))
            index[f] = space, N.packed(whole, key, space, cols, k).checkpoint(eager=True)
        space, kept = index[f]
        found = N.search_packed(kept, part, key, "_id", f"_miss_{f}", space, cols, k)
        return shelf.put(_joined(part, found, f, k, fresh), instead=part)

    for _ in range(max_iter):
        for f in visit:
            part = visited(part, f, f == visit[0])
        delta = part.agg(F.max("_moved")).first()[0] or 0.0
        # Shuffle files go when the driver collects its garbage.
        spark.sparkContext._jvm.System.gc()
        if delta < threshold:
            break
    return part.filter(holes).select(key, *[F.col(f).alias(f"_v_{f}") for f in feats])


def impute_iterative_knn(df: DataFrame, key: str, feats: Sequence[str], k: int = 5,
                         max_iter: int = 10, tol: float = 1e-3, donor_bytes: int = DONOR_BYTES) -> DataFrame:
    """IterativeImputer(KNeighborsRegressor(k), max_iter, tol) on
    ``feats``: start from column means, visit columns by ascending null
    count, predict each column's missing cells from the k nearest rows that
    observed it (Euclidean over the current values of the other columns),
    stop after ``max_iter`` sweeps or when ``max_row sum|dX| < tol *
    max|X_observed|``.

    Rows without nulls never change: they are indexed once and kept through all
    sweeps; only the rows with a null are rewritten, and they alone are indexed
    anew as donors for each visit.  Where all rows' features are counted to fit in
    ``donor_bytes``, donors are sorted arrays that are broadcast and a visit is one
    narrow map over the rows with nulls.  Beyond that a visit is one distributed
    search (:mod:`knn`) in which the complete rows keep their regions and blocks; where
    they are the fewer rows, all rows are dealt anew by the donors of the visit.  Either
    way is exact, ties go to the smallest key, and every visit's rows are written.

    They are not checkpointed: a checkpoint keeps the planner's estimate of its size, a
    join's is the product of its sides', and a join of the rows with what was found from
    them squared it in every visit, until the planner did nothing else."""
    feats, spark = list(feats), df.sparkSession
    st = df.agg(*[F.count_if(F.col(f).isNull()).alias(f"z_{f}") for f in feats],
                *[F.avg(f).alias(f"m_{f}") for f in feats],
                F.count_if(reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in feats])).alias("whole"),
                F.greatest(*[F.max(F.abs(F.col(f))) for f in feats], F.lit(0.0)).alias("amax"),
                F.count(F.lit(1)).alias("n")).first()
    visit = [f for f in sorted(feats, key=lambda f: st[f"z_{f}"]) if 0 < st[f"z_{f}"] < st["n"]]
    if not visit:
        return df
    rows = df.select(key, *[F.col(f).isNull().alias(f"_miss_{f}") for f in feats],
                     *[F.coalesce(F.col(f).cast("double"), F.lit(st[f"m_{f}"])).alias(f) for f in feats])
    with Shelf(spark, "impute") as shelf:
        filled = _swept(shelf.put(rows), key, feats, visit, st, k, max_iter, tol, donor_bytes, shelf).checkpoint(eager=True)
    out = df.join(filled, key, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_v_{c}")).alias(c) if c in feats else F.col(c)
                        for c in df.columns])


# --- before / after comparisons ------------------------------------------------------

def compare_numeric(original: DataFrame, variants: dict[str, DataFrame], cols: Sequence[str]) -> DataFrame:
    """Describe of the original and of each imputed frame, side by
    side, one row per (column, statistic)."""
    from scoutlab.operators.profile import describe
    stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]

    def long(df: DataFrame, name: str) -> DataFrame:
        dsc = describe(df, cols)
        entries = F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias(name))
                            for s in stats])
        return dsc.select("col_name", F.inline(entries))

    out = long(original, "original")
    for name, frame in variants.items():
        out = out.join(long(frame, name), ["col_name", "statistic"], "left")
    return out


def compare_density(original: DataFrame, variants: dict[str, DataFrame], key: str, cols: Sequence[str],
                    grid_points: int = 200) -> DataFrame:
    """G8 for G20: ``(col_name, variant, i, x, density)``, the curves of a column's
    original and imputed values on one grid.  The frames are joined by ``key`` once."""
    from scoutlab.operators.profile import kde_curves
    joined = original.select(key, *[F.col(c).alias(f"original:{c}") for c in cols])
    for name, frame in variants.items():
        joined = joined.join(frame.select(key, *[F.col(c).alias(f"{name}:{c}") for c in cols]), key)
    checkpoint_dir(original.sparkSession)
    joined = joined.checkpoint(eager=True)  # read once per column
    curves = [kde_curves(joined, [f"{name}:{c}" for name in ("original", *variants)], grid_points, shared=True) for c in cols]
    parts = F.split("col_name", ":", 2)
    return reduce(DataFrame.unionByName, curves).select(
        parts[1].alias("col_name"), parts[0].alias("variant"), "i", "x", "density")


def imputation_summary(before: DataFrame, after: DataFrame, used: dict[str, object]) -> DataFrame:
    """Per column the nulls that were filled, the value used and the nulls left."""
    cols = list(used)

    def nulls(df: DataFrame) -> DataFrame:
        return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])

    b, a = nulls(before).first(), nulls(after).first()
    rows = [(c, b[c] - a[c], None if used[c] is None else str(used[c]), a[c]) for c in cols]
    return before.sparkSession.createDataFrame(rows, "col_name STRING, n_imputed LONG, value_used STRING, n_left LONG")


def compare_categorical(before: DataFrame, after: DataFrame, c: str, top: int | None = 15,
                        marker: str = MISSING_MARKER) -> DataFrame:
    """G21 + J9: category counts before (nulls shown as the marker) and after
    imputation, aligned on the "before" categories (absent -> 0)."""
    b = before.select(F.coalesce(F.col(c), F.lit(marker)).alias(c)).groupBy(c).agg(
        F.count(F.lit(1)).alias("n_before"))
    if top:
        b = b.orderBy(F.col("n_before").desc(), F.col(c)).limit(top)
    a = after.select(F.coalesce(F.col(c), F.lit(marker)).alias(c)).groupBy(c).agg(
        F.count(F.lit(1)).alias("n_after"))
    return b.join(a, c, "left").select(c, "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))
