"""Quality rules with adaptive thresholds (operator 7).

Measures of a document are row-local expressions over its whole text.  Their
distributions are summarised per language and source by mergeable quantile
sketches, and each group's thresholds come from its own sketch.

The sketch is a log-linear histogram: a value keeps its PRECISION_BITS highest
bits, so a bucket is at most 1/32 of its value wide, and two sketches merge by
adding the counts of equal buckets.  It does not depend on the order of rows or
merges, so reruns agree.  Building one is a grouped count with a partial before
the shuffle; a source with a third of the rows sends one row per bucket and
task.  A group of fewer than MIN_GROUP documents uses the merged sketch of its
language, and below that the one of all documents.

A measure's fence is the median plus FENCE spreads, and every spread comes from
the group's own sketches.  It is the distance from the median to the quantile at
the measure's clean end, which junk at the other end cannot move, so up to half
of a group may be junk.  Where that quantile equals the median, as for symbols in
prose, the spread is what one event (Rule.floor) weighs in the group's median
document, whose words and lines are sketched too: sources of short texts get wider
fences than sources of long ones.  A document within FENCE events (Rule.spared) is
inside whatever its length, as one event in a short text is a large share.

Lower fences are not below 0, and long words at the far end cannot widen them
beyond twice the distance to the upper quartile.  Documents beyond a fence are
rejected; a group without outliers loses nothing.

Null text has no words and fails the base rules; null lang or source are
groups of their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoutlab.llm.common import settle, words

PRECISION_BITS = 6
MIN_GROUP = 30
FENCE = 4
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """One measure (a non-negative whole number) with its fences.

    ``clean``: the percentile at the clean end; below 50 for an upper fence,
    above 50 for a lower one.  ``floor``: the least spread, from the group's
    medians ``mid`` (of the measure), ``mid_words`` and ``mid_lines``.
    ``spared``: documents that are inside in any group.
    """
    name: str
    value: str
    clean: int
    floor: str
    spared: str = "false"


# An event is a pair of symbols, a line said again, six words said again (twelve
# covered).  Word lengths need no event: two to four buckets of their sketch.
RULES = (
    Rule("symbols", "n_symbols * 1000 div n_words", 10, "2000 div mid_words", f"n_symbols <= {2 * FENCE}"),
    Rule("dup_lines", "n_dup_lines * 1000 div n_lines", 10, "1000 div mid_lines", f"n_dup_lines <= {FENCE}"),
    Rule("repeats", "n_repeat_words * 1000 div n_words", 10, "12000 div mid_words", f"n_repeat_words <= {12 * FENCE}"),
    Rule("word_length_high", "word_chars * 100 div n_words", 10, "mid div 16"),
    Rule("word_length_low", "word_chars * 100 div n_words", 75, "mid div 16"),
)
# Sketched beside the measures, for the floors.
SIZES = {"mid_words": "n_words", "mid_lines": "n_lines"}


def _bind(value: Column, body) -> Column:
    """body(value) with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more; hashes: one per window.

    Windows are sorted by hash with their position; those next to an equal one
    are repeated.  Their positions, in order, each cover up to three words.
    """
    def positions(s: Column) -> Column:
        last = F.size(s) - 1

        def again(j: Column) -> Column:
            here = F.get(s, j)["h"]
            return (((j > 0) & (F.get(s, j - 1)["h"] == here))
                    | ((j < last) & (F.get(s, j + 1)["h"] == here)))

        return F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), last), again), lambda j: F.get(s, j)["at"]))

    def covered(p: Column) -> Column:
        steps = F.sequence(F.lit(0), F.size(p) - 1)
        return F.aggregate(steps, F.lit(0), lambda n, k: n + F.least(
            F.lit(3), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(3))))

    tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    found = _bind(_bind(tagged, positions), covered)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)


def measured(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    Needs text and keeps all columns; give rows with other columns of these
    names as a struct (:func:`scoutlab.llm.common.packed`).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    # An array column is made in one projection and used in the next, so that
    # lambdas look up a value instead of computing it.
    step = docs.select(*[F.col(c) for c in docs.columns], words(F.col("text")).alias("_words"), lines.alias("_lines"))
    w = F.col("_words")
    windows = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    hashes = _bind(w, lambda a: F.transform(windows, lambda i: F.xxhash64(F.get(a, i), F.get(a, i + 1), F.get(a, i + 2))))
    step = step.select(
        *[F.col(c) for c in docs.columns],
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("_hashes"))
    repeats = _bind(F.col("_hashes"), _repeat_words).cast("long")
    step = step.withColumn("n_repeat_words", repeats).drop("_hashes")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return step.withColumn("base_failed", failed)


def _bucket(value: Column) -> Column:
    """The lower end of the value's sketch bucket."""
    shift = F.greatest(F.length(F.bin(value)) - PRECISION_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(rows: DataFrame) -> DataFrame:
    """Sketches per language and source of the measured ``rows`` that pass the
    base rules: lang, source, rule (or size), bucket, n."""
    measures = {r.name: r.value for r in RULES} | SIZES
    values = F.array(*[F.struct(F.lit(name).alias("rule"), F.expr(value).cast("long").alias("value"))
                       for name, value in measures.items()])
    long = rows.filter(~F.col("base_failed")).select("lang", "source", F.inline(values))
    return long.groupBy("lang", "source", "rule", _bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Fence of every rule from sketches merged to ``keys``: one row per group."""
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("total", F.sum("n").over(group))

    def quantile(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("bucket")))

    at = {"mid": 50, "low": 10, "upper": 75, "high": 90}
    stats = ranked.groupBy(*keys, "rule").agg(F.max("total").alias("total"), *[quantile(p).alias(c) for c, p in at.items()])

    def of(rule: str, column: str) -> Column:
        return F.max(F.when(F.col("rule") == rule, F.col(column)))

    wide = stats.groupBy(*keys).agg(
        F.max("total").alias("total"), *[of(size, "mid").alias(size) for size in SIZES],
        *[of(r.name, c).alias(f"{r.name}_{c}") for r in RULES for c in at])
    return wide.select(*keys, "total", *[F.expr(fence_sql(r)).alias(r.name) for r in RULES])


def fence_sql(r: Rule) -> str:
    """The rule's fence over a group's medians and quantiles, named ``<rule>_mid`` and so on."""
    mid, low, upper, high = (f"{r.name}_{c}" for c in ("mid", "low", "upper", "high"))
    floor = re.sub(r"\bmid\b", mid, r.floor)
    if r.clean < 50:
        return f"{mid} + {FENCE} * greatest({mid} - {low}, {floor})"
    return f"greatest(0, {mid} - {FENCE} * greatest(least({high} - {mid}, 2 * ({upper} - {mid})), {floor}))"


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and a fence per rule, from the smallest group that is large enough."""
    own = _fences(sketch, ["lang", "source"])
    lang = _fences(sketch, ["lang"]).withColumnsRenamed({"lang": "_lang", "total": "_total"} | {r.name: f"_{r.name}" for r in RULES})
    every = _fences(sketch.withColumn("_all", F.lit(1)), ["_all"]).select(*[F.col(r.name).alias(f"__{r.name}") for r in RULES])
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").join(F.broadcast(every))
    return joined.select("lang", "source", *[
        F.when(F.col("total") >= MIN_GROUP, F.col(r.name)).when(F.col("_total") >= MIN_GROUP, F.col(f"_{r.name}"))
         .otherwise(F.col(f"__{r.name}")).alias(r.name) for r in RULES])


def judged(rows: DataFrame) -> DataFrame:
    """Add ``kept`` to measured rows (settle them first: they are read twice)."""
    fences = settle(thresholds(sketches(rows)), "quality-thresholds")
    fences = fences.withColumnsRenamed({"lang": "_lang", "source": "_source"} | {r.name: f"_fence_{r.name}" for r in RULES})
    joined = rows.join(fences, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for r in RULES:
        value, fence = F.expr(r.value), F.col(f"_fence_{r.name}")
        within = (value <= fence) if r.clean < 50 else (value >= fence)
        inside = inside & F.coalesce(within | F.expr(r.spared), F.lit(True))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(inside)
    return joined.withColumn("kept", kept).drop("_lang", "_source", *[f"_fence_{r.name}" for r in RULES])
