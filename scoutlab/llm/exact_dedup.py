"""Exact deduplication with counting quotient filters (operator 10).

Each partition builds counting quotient filters over 64-bit fingerprints of its
texts: the high bits (the quotient) say which run a fingerprint belongs to, the
low bits (the remainder) are kept sorted within the run, with a count per
remainder.  A remainder is stored whole, so merging two filters - interleaving
sorted remainders and adding counts - loses nothing.  Filters are cut by their
highest quotient bits and merged cut by cut; a group of any number of copies is
one (remainder, count) pair in each.

Fingerprints whose merged count is above one route their rows to byte
verification: those rows alone are grouped by their whole normalised text, with
partial aggregation before the shuffle.  Fingerprints that merely collide fall
apart there, so the result is exact.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
Of equal texts the row with the largest doc_id stays (a null doc_id is smaller
than any other).  Rows that repeat both doc_id and text are one document twice
over: both carry kept = true, and :func:`drop_copies` leaves one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scoutlab.llm.common import Scratch, lower_ascii, packed, settle, small_side

# Fingerprints expected in one merged cut of the filters (16 bytes each).
CUT_ROWS = 1 << 18
# Fingerprints held by a task before it emits its filter and starts another.
FILTER_ROWS = 1 << 21


def cut_bits(rows: int) -> int:
    """High quotient bits that give cuts of about CUT_ROWS fingerprints."""
    return max(4, math.ceil(math.log2(max(1, rows) / CUT_ROWS))) if rows > CUT_ROWS else 4


def build_filter(fps: np.ndarray, bits: int) -> pd.DataFrame:
    """The counting quotient filter of ``fps`` (uint64), one row per cut.

    remainders: the sorted low bits, 8 bytes each; counts: of each, 8 bytes.
    """
    values, counts = np.unique(fps, return_counts=True)
    low = np.uint64(64 - bits)
    cuts = (values >> low).astype(np.int64)
    remainders = values & np.uint64((1 << (64 - bits)) - 1)
    starts = np.flatnonzero(np.r_[True, cuts[1:] != cuts[:-1]]) if len(cuts) else np.empty(0, int)
    ends = np.r_[starts[1:], len(cuts)].astype(int) if len(starts) else starts
    return pd.DataFrame({
        "cut": cuts[starts],
        "remainders": [remainders[a:b].astype("<u8").tobytes() for a, b in zip(starts, ends)],
        "counts": [counts[a:b].astype("<i8").tobytes() for a, b in zip(starts, ends)],
    })


def merge_filters(remainders: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Merge runs of one cut by their sorted remainders; counts add up."""
    r = np.concatenate([np.frombuffer(x, "<u8") for x in remainders])
    c = np.concatenate([np.frombuffer(x, "<i8") for x in counts])
    order = np.argsort(r, kind="stable")
    r, c = r[order], c[order]
    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    return r[first], np.add.reduceat(c, first)


def repeated_fingerprints(fps: DataFrame, bits: int) -> DataFrame:
    """Fingerprints (column fp) that occur more than once, with their counts."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch["fp"].to_numpy(np.int64).view(np.uint64))
            n += len(batch)
            if n >= FILTER_ROWS:
                yield build_filter(np.concatenate(held), bits)
                held, n = [], 0
        if n:
            yield build_filter(np.concatenate(held), bits)

    def merge(filters: pd.DataFrame) -> pd.DataFrame:
        r, c = merge_filters(list(filters["remainders"]), list(filters["counts"]))
        cut = np.uint64(int(filters["cut"].iloc[0])) << np.uint64(64 - bits)
        many = c > 1
        return pd.DataFrame({"fp": (r[many] | cut).view(np.int64), "n": c[many]})

    filters = fps.select("fp").mapInPandas(build, "cut long, remainders binary, counts binary")
    return filters.groupBy("cut").applyInPandas(merge, "fp long, n long")


def fingerprinted(docs: DataFrame) -> DataFrame:
    norm = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", norm.alias("norm")).withColumn("fp", F.xxhash64("norm"))


def copy_groups(docs: DataFrame) -> DataFrame:
    """Groups of two rows or more: text_sha256, keep_id, group_size, repeated.

    ``repeated`` tells that more than one row of the group has the doc_id that
    stays; it is counted over the narrow routed rows only.
    """
    keyed = fingerprinted(docs)
    repeated = settle(repeated_fingerprints(keyed, cut_bits(docs.count())), "repeated-fingerprints")
    routed = keyed.join(repeated.select("fp"), "fp", "left_semi")
    groups = (routed.groupBy("fp", "norm")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1"))
    twice = (routed.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select(F.col("fp").alias("_fp"), F.col("doc_id").alias("_id")))
    groups = (groups.select("fp", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
              .join(twice, (F.col("fp") == F.col("_fp")) & F.col("keep_id").eqNullSafe(F.col("_id")), "left"))
    return settle(groups.select("text_sha256", "keep_id", "group_size", F.col("_fp").isNotNull().alias("repeated")),
                  "copy-groups")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    norm = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", F.sha2(norm.cast("binary"), 256).alias("text_sha256"))
    joined = rows.join(copy_groups(docs), "text_sha256", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True))
         .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, same columns.

    The row of :func:`exact_duplicates`; of rows that also repeat its doc_id, one.
    The groups (a narrow row for each text that has copies) are broadcast where
    they are counted to be small; whole rows are shuffled only beyond that.
    """
    norm = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    with Scratch() as scratch:
        groups = scratch.keep(copy_groups(docs))
    wanted = small_side(groups, 120).select(F.col("text_sha256").alias("_sha"), F.col("keep_id").alias("_keep"),
                                            F.col("repeated").alias("_repeated"))
    joined = packed(docs, "doc_id", F.sha2(norm.cast("binary"), 256).alias("_sha")).join(wanted, "_sha", "left")
    stays = F.col("_repeated").isNull() | F.col("doc_id").eqNullSafe(F.col("_keep"))
    once = joined.filter(stays & ~F.coalesce("_repeated", F.lit(False))).select("_row.*")
    if groups.filter("repeated").isEmpty():
        return once
    twice = joined.filter(stays & F.col("_repeated")).dropDuplicates(["_sha"]).select("_row.*")
    return once.unionByName(twice)
