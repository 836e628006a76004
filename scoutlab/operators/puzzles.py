"""Puzzle-table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlab.functions import scalar as fn
from scoutlab.functions.predicates import PuzzleFilter


def with_derived(df: DataFrame, moves: str = "Moves", themes: str = "Themes",
                 rating: str = "Rating") -> DataFrame:
    """Analysis columns: move count, theme count (F1), difficulty class
    label and ordinal (F4)."""
    out = df
    if moves in df.columns:
        out = out.withColumn("num_movimientos", fn.token_count(moves))
    if themes in df.columns:
        out = out.withColumn("num_temas", fn.token_count(themes))
    return (out.withColumn("nivel_dificultad", fn.difficulty_class(rating))
            .withColumn("nivel_ordinal", fn.difficulty_ordinal(rating)))


def filtered(df: DataFrame, flt: PuzzleFilter) -> DataFrame:
    return df.filter(flt.column())


def puzzle_list(df: DataFrame, flt: PuzzleFilter, n: int = 4, key: str = "PuzzleId") -> DataFrame:
    """First n matching puzzles; a key order makes "first" deterministic."""
    return filtered(df, flt).orderBy(F.col(key)).limit(n)


def puzzle_averages(df: DataFrame, flt: PuzzleFilter) -> DataFrame:
    """q2_a — filtered mean rating and popularity, rounded to 2."""
    return filtered(df, flt).agg(
        F.round(F.avg(F.col("Rating").try_cast("double")), 2).alias("Rating_Promedio"),
        F.round(F.avg(F.col("Popularity").try_cast("double")), 2).alias("Popularidad_Promedio"))


def most_played_top5(df: DataFrame, flt: PuzzleFilter) -> DataFrame:
    """q3_a."""
    return (filtered(df, flt)
            .select("PuzzleId", F.col("NbPlays").try_cast("int").alias("Numero_Jugadas"), "Rating")
            .orderBy(F.col("Numero_Jugadas").desc_nulls_last(), F.col("PuzzleId")).limit(5))


def puzzles_by_popularity(df: DataFrame, flt: PuzzleFilter) -> DataFrame:
    """q4_a — puzzles per popularity with mean rating, 5 largest."""
    return (filtered(df, flt).groupBy("Popularity")
            .agg(F.count(F.lit(1)).alias("Cantidad_Puzzles"),
                 F.round(F.avg(F.col("Rating").try_cast("double")), 2).alias("Rating_Promedio"))
            .orderBy(F.col("Cantidad_Puzzles").desc(), F.col("Popularity").asc_nulls_first()).limit(5))


def deviation_frequency(df: DataFrame, flt: PuzzleFilter) -> DataFrame:
    """q5_a."""
    return (filtered(df, flt).groupBy("RatingDeviation")
            .agg(F.count(F.lit(1)).alias("Frecuencia"))
            .orderBy(F.col("Frecuencia").desc(), F.col("RatingDeviation").asc_nulls_first()).limit(5))


def chess_kpis(df: DataFrame) -> DataFrame:
    """Count, mean rating, mean popularity, total plays."""
    return df.agg(F.count(F.lit(1)).alias("n_puzzles"),
                  F.avg("Rating").alias("mean_rating"),
                  F.avg("Popularity").alias("mean_popularity"),
                  F.coalesce(F.sum("NbPlays"), F.lit(0)).cast("long").alias("total_plays"))


def class_balance(df: DataFrame, rating: str = "Rating") -> DataFrame:
    """Count and share (percent of all rows) per difficulty class in the
    fixed class order; empty classes are kept with 0.

    One pass: a single-row aggregate of conditional counts plus the total
    (map-side partials only), unpivoted to the four classes.
    """
    cls = fn.difficulty_class(rating)
    one = df.agg(F.count(F.lit(1)).alias("total"),
                 *[F.count_if(cls == F.lit(lbl)).alias(f"n{i}")
                   for i, lbl in enumerate(fn.DIFFICULTY_LABELS)])
    stacked = ", ".join(f"{i}, '{lbl}', n{i}" for i, lbl in enumerate(fn.DIFFICULTY_LABELS))
    return one.selectExpr(
        "total", f"stack({len(fn.DIFFICULTY_LABELS)}, {stacked}) AS (class_order, nivel_dificultad, n)"
    ).select("class_order", "nivel_dificultad", "n",
             F.coalesce(fn.percent("n", "total"), F.lit(0.0)).alias("pct"))


def first_token_view(df: DataFrame, moves: str = "Moves", themes: str = "Themes") -> DataFrame:
    """first move and display form of the themes."""
    return df.select("PuzzleId", fn.first_token(moves).alias("first_move"),
                     fn.display_list(themes).alias("themes_display"))
