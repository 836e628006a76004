"""Mixing sources to target weights with a low-discrepancy schedule (operator 5).

Slot k of the schedule is the point k * golden ratio (mod 1) of the unit
interval, on which every source owns a stretch as long as its share of the
target words.  Consecutive points spread evenly, so at any moment every source
has had its share of slots but for a few.  Slots are ranked per source; the
r-th slot of a source takes its r-th block, and starts over after the last one.
Blocks hold equal numbers of words of the source's documents in shuffled order
(by the md5 of seed and doc_id).  Slots after a source's target is met are
void, and a source that the finite schedule leaves short gets closing slots,
so a source's words meet its target to the word.

Everything is DataFrame functions.  Ranks and running sums are built in two
levels (within cells, then over cell totals), so a source that holds a third of
the rows is never in one task.

Size of a document: its words (null text: none).  Sources sort by code point,
null last, and weigh 1, 2, 3, repeating.  Documents without words, sources
without words and empty tables take nothing.  doc_id is expected to identify a
document; rows that repeat it are separate documents in the stream.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoutlab.llm.common import Scratch, numbered, packed, settle, small_side, words

# Words in a block, and so in a slot of the schedule.
BLOCK = 1024
# Documents expected in one cell of the shuffled order.
CELL_DOCS = 1 << 16
# The golden ratio's fraction in 32 bits, the odd whole number nearest to it.
GOLDEN = 2654435769
RING = 1 << 32
# Most times a source's words may be taken.
MAX_REPEATS = 3


def _source_key() -> list[Column]:
    return [F.col("source").isNull(), F.col("source")]


def with_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add weight and target to ``sources`` (source, source_size).

    Water filling: words are shared by weight; a source whose share is above
    max_repeats times its size stops there and the rest is shared anew, until
    no share is above.  Each round is one aggregate of the source table.
    """
    order = Window.orderBy(*_source_key())
    table = settle(sources.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
                   .withColumn("cap", F.col("source_size") * max_repeats), "mix-sources")
    level, full = 0.0, -1
    while True:
        stopped = F.col("cap") <= F.col("weight") * F.lit(level)
        one = table.agg(
            F.sum("source_size").alias("total"),
            F.coalesce(F.sum(F.when(stopped, F.col("cap"))), F.lit(0)).alias("spent"),
            F.count(F.when(stopped, 1)).alias("n"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0)).alias("open")).first()
        if one["n"] == full or not one["open"]:
            break
        full, level = one["n"], (one["total"] - one["spent"]) / one["open"]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return table.withColumn("target", target).withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))


def stream(docs: DataFrame, seed: int, rows: int) -> DataFrame:
    """Add ``start``: the words of the source before this document, in shuffled order."""
    digits = max(1, math.ceil(math.log(max(1, rows / CELL_DOCS), 16)))
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    docs = docs.withColumn("_order", shuffled).withColumn("_cell", F.substring("_order", 1, digits))
    cells = docs.groupBy("source", "_cell").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cells.select(F.col("source").alias("_source"), F.col("_cell").alias("_c"),
                          F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_first"))
    within = (Window.partitionBy("source", "_cell").orderBy("_order", "doc_id", "_rid")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (docs.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(firsts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_c")))
            .withColumn("start", F.col("_first") + F.col("_inside"))
            .drop("_first", "_inside", "_source", "_c", "_cell", "_order"))


def schedule(spark, sources: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """The slots that take words: slot, source, rank, block, take.

    ``take``: words the slot takes from the front of its block.  Closing slots
    have numbers after the last regular one.
    """
    slots = math.ceil(total / block)
    # Stretches of the ring, and the equal buckets of it that they touch: the
    # join of points and stretches is on the bucket.
    buckets = max(1, min(1 << 20, slots // 4096))
    upto = Window.orderBy(*_source_key()).rowsBetween(Window.unboundedPreceding, 0)
    ring = (sources.filter("quota > 0")
            .withColumn("_upto", F.sum("target").over(upto))
            .withColumn("hi", F.least(F.floor(F.col("_upto") / F.lit(float(max(1, total))) * RING), F.lit(RING)).cast("long"))
            .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy(*_source_key())), F.lit(0)))
            .withColumn("hi", F.when(F.lead("hi").over(Window.orderBy(*_source_key())).isNull(), F.lit(RING)).otherwise(F.col("hi")))
            .drop("_upto"))
    width = RING // buckets + 1
    stretches = ring.filter("hi > lo").select(
        "source", "lo", "hi",
        F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))).alias("bucket"))
    points = (spark.range(slots).withColumnRenamed("id", "slot")
              .withColumn("x", F.pmod(F.pmod("slot", F.lit(RING // 2)) * F.lit(GOLDEN)
                                      + F.floor(F.col("slot") / (RING // 2)) * F.lit(7), F.lit(RING)))
              .withColumn("bucket", F.expr(f"x div {width}")))
    drawn = (points.join(stretches, "bucket").filter("x >= lo and x < hi")
             .select("slot", "source"))
    ranked = numbered(settle(drawn, "mix-slots"), ["source"], "slot", "rank")
    had = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("source", "_s")
    size, quota = F.col("source_size"), F.col("quota")
    blocks = F.ceil(size / F.lit(block)).cast("long")
    left = quota % size
    needed = (F.expr("quota div source_size") * blocks + F.ceil(left / F.lit(block))).cast("long")
    plan = sources.filter("quota > 0").select("source", "source_size", "quota", blocks.alias("blocks"), needed.alias("needed"))
    closing = (plan.join(had, F.col("source").eqNullSafe(F.col("_s")), "left")
               .withColumn("_n", F.coalesce("_n", F.lit(0))).filter("_n < needed")
               .select(F.explode(F.sequence(F.col("_n"), F.col("needed") - 1)).alias("rank"), "source")
               .withColumn("slot", F.lit(slots) + F.col("rank")))
    every = ranked.select("slot", "source", "rank").unionByName(closing.select("slot", "source", "rank"))
    plan = plan.withColumnRenamed("source", "_s")
    taken = every.join(plan, F.col("source").eqNullSafe(F.col("_s"))).filter("rank < needed")
    at = F.expr("rank % blocks")
    return taken.select(
        "slot", "source", "rank", at.alias("block"),
        F.least(F.lit(block), F.col("source_size") - at * block,
                F.col("quota") - F.expr("rank div blocks") * F.col("source_size") - at * block).alias("take"))


def mix(docs: DataFrame, seed: int = 42, block: int = BLOCK, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source, source_size, target, taken, and ``carry``.

    ``taken``: words that the schedule takes from the document, with repeats.
    """
    spark = docs.sparkSession
    sized = settle(docs.select("doc_id", "source", *carry, F.size(words(F.col("text"))).cast("long").alias("size"),
                               F.monotonically_increasing_id().alias("_rid")), "mix-sizes")
    sources = settle(with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    one = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("rows")).first()
    takes = schedule(spark, sources, one["total"], block)
    # Per block: how often the schedule takes so many words of it.
    per_block = (takes.groupBy(F.col("source").alias("_bs"), F.col("block").alias("_bb"), F.col("take").alias("_take"))
                 .agg(F.count(F.lit(1)).alias("_times")))
    placed = settle(stream(sized, seed, one["rows"]), "mix-stream")
    pieces = placed.filter("size > 0").select(
        "_rid", "source", "start", (F.col("start") + F.col("size")).alias("_end"),
        F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("_block"))
    front = F.col("_block") * block
    words_taken = F.greatest(F.lit(0), F.least(F.col("_end"), front + F.col("_take")) - F.greatest(F.col("start"), front))
    taken = (pieces.join(per_block, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_block") == F.col("_bb")))
             .groupBy("_rid").agg(F.sum(words_taken * F.col("_times")).alias("taken")))
    shares = sources.select(F.col("source").alias("_s"), "source_size", "target")
    return (placed.join(taken, "_rid", "left")
            .join(shares, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *carry))


def mixed_documents(docs: DataFrame, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """``docs`` as the mix takes them, same columns.

    A document comes as often as its taken words make whole documents, rounded:
    not at all, once, or up to MAX_REPEATS times.  Documents are told apart by
    doc_id and text, so rows that repeat both share their words.
    """
    keyed = packed(docs, "doc_id", "source", "text", F.xxhash64("doc_id", "text").alias("_key"))
    with Scratch() as scratch:
        takes = mix(keyed, seed, block, carry=("_key",))
        times = (takes.groupBy(F.col("doc_id").alias("_doc"), F.col("_key").alias("_k"))
                 .agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
                 .withColumn("_times", F.floor(F.col("_taken") / F.greatest("_size", F.lit(1)) + 0.5).cast("int"))
                 .filter("_times > 0").select("_doc", "_k", "_times"))
        times = small_side(scratch.keep(settle(times, "mix-times")), 64)
    joined = keyed.join(times, (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    return (joined.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
            .select("_row.*"))
