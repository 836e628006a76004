"""The corpus pipeline: stages over ``documents``, each written and read again.

1. quality rules: documents that fail go
2. exact dedup: one row of each group of equal texts stays
3. MinHash near-dedup: one document of each linked group stays
4. mixing: documents repeat or go so that sources meet their target words
5. packing: token sequences

The output is the pieces of the packed sequences.  SQL cannot express the
tokenizer and the sketches, so ORACLE_SQL is None; ``tests/llm`` holds every
stage against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlab.llm import exact_dedup, mixing, near_dedup, packing, quality
from scoutlab.llm.common import packed, settle, table

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = settle(quality.measured(packed(docs, "text", "lang", "source")).drop("text"), "pipeline-measures")
    return quality.judged(rows).filter("kept").select("_row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; every stage but the last is written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
