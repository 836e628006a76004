"""Model preparation (G22-G27): deterministic and group-safe splits,
population-std scaling, one-hot encoding, feature matrix.

Splits are exact in size and reproducible: rows are ordered by a seeded
digest of the key (the key breaks ties) and the first
``ceil(test_size * n)`` positions form the test set.  Nothing is sorted or
shuffled whole: rows are counted by the digest's first digits, the cut value is
found inside the one bucket that holds it, and the split is a comparison in
place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoutlab.functions.scalar import MISSING_MARKER
from scoutlab.operators.profile import seeded_digest, value_ranks


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``; test size is exactly ``ceil(test_size * n)``
    (``key`` is unique)."""
    order = seeded_digest(key, seed=seed)
    keyed = df.select(F.col(key).alias("k"), order.alias("h"), F.substring(order, 1, 5).alias("bucket"))
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # One row per bucket, at most 16**5 whatever the table.
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy(F.lit(1))
    hit = (counts.withColumn("upto", F.sum("n").over(upto)).withColumn("want", F.ceil(F.lit(test_size) * F.sum("n").over(total)))
           .filter("upto >= want and upto - n < want").first())
    if hit is None:
        return df.withColumn("is_test", F.lit(False))
    last = (keyed.filter(F.col("bucket") == hit["bucket"]).orderBy("h", "k").limit(int(hit["want"] - hit["upto"] + hit["n"]))
            .agg(F.max(F.struct("h", "k")).alias("cut")).first()["cut"])
    is_test = (order < F.lit(last["h"])) | ((order == F.lit(last["h"])) & (F.col(key) <= F.lit(last["k"])))
    return df.withColumn("is_test", F.coalesce(is_test, F.lit(False)))


def group_split(df: DataFrame, group: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Split by group so no group is on both sides; the test side has
    exactly ``ceil(test_size * n_groups)`` groups.  A row without a group has a
    null ``is_test``: it is on neither side."""
    keys = df.select(group).filter(F.col(group).isNotNull()).distinct()
    assigned = train_test_split(keys, group, test_size, seed)
    return df.join(assigned, group, "left")


def scaler_stats(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column, fitted on the training rows
    (one small row comes back)."""
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s{i}"]
        out[c] = (row[f"m{i}"], 1.0 if not s else s)  # std 0 -> divide by 1
    return out


def standard_scale(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / std_pop`` with (train) statistics."""
    return df.select(*[((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1])).alias(c) if c in stats
                       else F.col(c) for c in df.columns])


MAX_CATEGORIES = 10_000


def categories(train: DataFrame, c: str, marker: str = MISSING_MARKER, most: int = MAX_CATEGORIES) -> list[str]:
    """Sorted categories of a column on the training rows (null -> marker), for
    explicit columns; a column with more than ``most`` is an error: a table cannot be
    that wide, and :func:`encode` makes sparse vectors instead."""
    rows = train.select(F.coalesce(F.col(c), F.lit(marker)).alias(c)).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{c} has more than {most} categories: use encode")
    return sorted(r[c] for r in rows)


def one_hot_columns(df: DataFrame, c: str, cats: Sequence[str], marker: str = MISSING_MARKER) -> DataFrame:
    """G25 as explicit 0/1 columns ``{c}_{category}``; unknown -> all zeros."""
    v = F.coalesce(F.col(c), F.lit(marker))
    return df.select("*", *[(v == F.lit(cat)).cast("double").alias(f"{c}_{cat}") for cat in cats])


def category_index(train: DataFrame, cols: Sequence[str], marker: str = MISSING_MARKER) -> DataFrame:
    """``(col_name, value, idx, n)``: every category of the training rows with its number
    in sorted order (null -> marker) and the column's number of categories.

    Distinct values are range-partitioned and numbered by a two-level prefix sum
    (:func:`profile.value_ranks`): no task or driver holds a column's categories."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.coalesce(F.col(c).cast("string"), F.lit(marker)).alias("value")) for c in cols])
    ranks = value_ranks(train.select(F.inline(pairs)).distinct())
    return ranks.select("col_name", "value", F.col("before").cast("int").alias("idx"), F.col("n").cast("int").alias("n")).checkpoint(eager=True)


def encode(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], index: DataFrame,
           out: str = "features", marker: str = MISSING_MARKER) -> DataFrame:
    """G25 + G26: adds ``out``, a sparse vector ``struct<size, indices, values>``: the
    numeric columns, then per category column one slot per category and a last one
    for values that the index lacks.  A null number is NaN, as in the reference.

    Categories meet their number in one join per column, broadcast where Spark
    measures the index to be small and split by AQE where one value is frequent."""
    sizes = {r["col_name"]: r["n"] for r in index.groupBy("col_name").agg(F.max("n").alias("n")).collect()}
    slots, offset = [], len(num_cols)
    for i, c in enumerate(cat_cols):
        n = sizes.get(c, 0)
        side = index.filter(F.col("col_name") == c).select(F.col("value").alias(f"_v{i}"), F.col("idx").alias(f"_i{i}"))
        df = df.join(side, F.coalesce(F.col(c).cast("string"), F.lit(marker)) == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        slots.append(F.lit(offset) + F.coalesce(F.col(f"_i{i}"), F.lit(n)))
        offset += n + 1
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in num_cols]
    vector = F.struct(F.lit(offset).alias("size"), F.array(*[F.lit(i) for i in range(len(num_cols))], *slots).alias("indices"),
                      F.array(*numbers, *[F.lit(1.0) for _ in slots]).alias("values"))
    return df.withColumn(out, vector).drop(*[f"_i{i}" for i in range(len(cat_cols))])


def dense(vector: str = "features") -> Column:
    """A sparse vector of :func:`encode` as an array of doubles."""
    v = F.col(vector)
    at = v["indices"]  # ascending

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0), n.cast("int"))

    # Each value behind the zeros since the one before: no search per slot.
    runs = F.transform(at, lambda x, j: F.concat(zeros(x - F.coalesce(F.get(at, j - 1), F.lit(-1)) - 1), F.array(F.get(v["values"], j))))
    rest = zeros(v["size"] - F.coalesce(F.get(at, F.size(at) - 1), F.lit(-1)) - 1)
    return F.concat(F.flatten(runs), rest)


def feature_matrix(df: DataFrame, key: str, target: str, num_cols: Sequence[str], cat_cols: Sequence[str],
                   drop: Sequence[str] = (), test_size: float = 0.2, seed: int = 42, group: str | None = None) -> DataFrame:
    """G26 + G27: split (by ``group`` where one is given, so that none is on both
    sides), fit scaler and encoder on train only, transform both sides; returns
    ``key, is_test, target, features``."""
    data = df.drop(*[c for c in drop if c not in (key, target, group)])
    data = data.select(key, target, *([group] if group else []), *num_cols, *cat_cols)
    split = group_split(data, group, test_size, seed) if group else train_test_split(data, key, test_size, seed)
    train = split.filter(~F.col("is_test"))
    scaled = standard_scale(split, scaler_stats(train, num_cols))
    return encode(scaled, num_cols, cat_cols, category_index(train, cat_cols)).select(key, "is_test", target, "features")
