"""Row-local puzzle enrichment on a stream.

``stream_puzzle_features`` reads new Parquet files of a puzzle table as
they land, adds the difficulty class, token counts and the six chess
features (all narrow, stateless expressions — no watermark is needed) and
appends to a Parquet sink.  The checkpoint location must be a shared
folder on a cluster; exactly-once output comes from the file sink's commit
log plus the source offsets in that checkpoint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from scoutlab.functions import scalar as fn
from scoutlab.operators.chess.features import chess_features

PUZZLE_SCHEMA = T.StructType([
    T.StructField("PuzzleId", T.StringType()), T.StructField("FEN", T.StringType()),
    T.StructField("Moves", T.StringType()), T.StructField("Rating", T.IntegerType()),
    T.StructField("RatingDeviation", T.IntegerType()), T.StructField("Popularity", T.IntegerType()),
    T.StructField("NbPlays", T.IntegerType()), T.StructField("Themes", T.StringType()),
    T.StructField("GameUrl", T.StringType()), T.StructField("OpeningTags", T.StringType()),
])


def stream_puzzle_features(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                           available_now: bool = True, max_files_per_trigger: int = 64) -> StreamingQuery:
    src = (spark.readStream.schema(PUZZLE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    enriched = chess_features(src).select(
        "*", fn.difficulty_class("Rating").alias("nivel_dificultad"),
        fn.token_count("Moves").alias("num_movimientos"), fn.token_count("Themes").alias("num_temas"))
    writer = (enriched.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
