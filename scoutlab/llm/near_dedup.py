"""MinHash near-deduplication by fast similarity sketching (operator 8).

Sketch.  A set's sketch has T coordinates (bins).  In round i every shingle is
hashed to a bin and a value; a bin keeps the smallest (round, value) that it
gets.  Rounds 0..T-1 choose the bin by hash; rounds T..2T-1 send every shingle
to bin i - T, so that every coordinate fills for any non-empty set.  A set
stops when its bins are full, after about T ln T hashes.  Two sets agree on a
coordinate with probability equal to their similarity, with concentration.

Banding.  BANDS bands of ROWS of the coordinates; a pair of similarity 0.8 shares no
band with probability (1 - 0.8**6)**48 < 5e-7.

Verification.  Every link is confirmed on the full sets of shingle hashes.

No group emits all its pairs.  Documents of equal sets are one class, counted
with partial aggregation.  In each band's bucket the classes are first compared
with the bucket's most central class alone (the one whose buckets are largest:
in a family of copies, close to the original).  Confirmed links make
components, and only classes of different components that share a bucket are
still to be compared: those outside a bucket's largest component against the
others.  A pair is set aside without fetching its sets only by its sizes, which
is exact, or by two bits of each coordinate, when they differ in more places
than a linked pair's would by five standard deviations (3e-7).  A pair is taken
up in one of the buckets that it shares.  Large buckets are split over tasks.

A document's set: distinct 4-word shingles of the text with A-Z lower-cased;
with fewer words the whole sequence as one; null, empty or blank texts have an
empty set and link with nothing.  Rows that repeat are members of one class.  A
null doc_id is larger than any other, and :func:`drop_near_copies` never drops
a row without one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scoutlab.llm.common import Scratch, packed, settle, small_side
from scoutlab.llm.components import components
from scoutlab.llm.shingles import mix, shingle_sets

WIDTH = 4
PERCENT = 80
BANDS, ROWS = 48, 6
T = 768  # coordinates; the first BANDS * ROWS are banded, all are compared
BIT_WORDS = (T + 63) // 64
# A linked pair's coordinates differ in their two bits in T * (1 - 0.8) * 3 / 4
# = 115 places, with a standard deviation of 9.9; with more than this many
# apart the pair is not linked.
MAX_APART = 165
# Classes of a bucket compared with the rest in one task.
SPLIT = 512
_U = np.uint64


def fast_similarity_sketch(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """Sketches of the sets (uint64 arrays), one row of t coordinates each.

    A coordinate holds round * 2**48 + the low 48 bits of the hash.  Rows of
    empty sets hold the largest number throughout.
    """
    out = np.full(len(sets) * t, _U(2**64 - 1), _U)
    table = out.reshape(-1, t)
    items = np.concatenate(sets) if sets else np.empty(0, _U)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    open_ = np.unique(owner)
    for i in range(2 * t):
        if not len(items):
            break
        h = mix(items ^ mix(np.array([i + 1], _U))[0])
        if i < t:
            bins = ((h >> _U(48)) * _U(t) >> _U(16)).astype(np.int64)
        else:
            bins = np.full(len(h), i - t)
        np.minimum.at(out, owner * t + bins, (h & _U(2**48 - 1)) | _U(i << 48))
        done = (table[open_] != _U(2**64 - 1)).all(1)
        if done.any():
            open_ = open_[~done]
            still = np.isin(owner, open_)
            items, owner = items[still], owner[still]
    return table


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = sketches[:, :BANDS * ROWS].reshape(len(sketches), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * _U(0x9FB21C651E98DF25) ^ parts[:, :, k])
    return key


def two_bits(sketches: np.ndarray) -> np.ndarray:
    """Two bits per coordinate, as two planes of BIT_WORDS 64-bit words per row."""
    planes = []
    for shift in (63, 62):
        bits = (mix(sketches) >> _U(shift) & _U(1)).astype(np.uint8)
        bits = np.pad(bits, ((0, 0), (0, BIT_WORDS * 64 - bits.shape[1])))
        planes.append(np.packbits(bits, axis=1).view(">u8").astype(_U))
    return np.concatenate(planes, axis=1)


def signed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, h1, h2 (128 bits of the set), bands, bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch.column(1), WIDTH):
                sketches = fast_similarity_sketch(sets)
                full = [len(s) > 0 for s in sets]
                bands, bits = band_keys(sketches).view(np.int64), two_bits(sketches).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(s.sum(dtype=_U).view(np.int64)) for s in sets], pa.int64()),
                    pa.array([int(np.bitwise_xor.reduce(mix(s ^ _U(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0
                              for s in sets], pa.int64()),
                    pa.array([b if f else None for b, f in zip(bands, full)], pa.list_(pa.int64())),
                    pa.array([b if f else None for b, f in zip(bits, full)], pa.list_(pa.int64())),
                ], names=["doc_id", "n_shingles", "h1", "h2", "bands", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, bits array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, items (its shingle hashes) for the classes in ``wanted`` (node, doc, h1, h2)."""
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("doc"))).select("node", "h1", "h2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for row, sets in shingle_sets(batch.column(3), WIDTH):
                # A doc_id may repeat with other texts: keep the class's own.
                same = [int(s.sum(dtype=_U).view(np.int64)) == h1[row + k] and len(s) > 0
                        and int(np.bitwise_xor.reduce(mix(s ^ _U(0x5851F42D4C957F2D))).view(np.int64)) == h2[row + k]
                        for k, s in enumerate(sets)]
                nodes = batch.column(0).slice(row, len(sets)).filter(pa.array(same, pa.bool_()))
                items = pa.array([s.view(np.int64) for s, ok in zip(sets, same) if ok], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([nodes, items], names=["node", "items"])

    return rows.mapInArrow(run, "node long, items array<long>").groupBy("node").agg(F.first("items").alias("items"))


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _apart(a: str, b: str) -> Column:
    """Coordinates that differ in their two bits."""
    apart = F.lit(0)
    for k in range(BIT_WORDS):
        planes = [F.col(f"{a}g{j}").bitwiseXOR(F.col(f"{b}g{j}")) for j in (k, k + BIT_WORDS)]
        apart = apart + F.bit_count(planes[0].bitwiseOR(planes[1]))
    return apart


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets have a similarity of PERCENT or more."""
    joined = (pairs.join(sets.select(F.col("node").alias("v"), F.col("items").alias("iv")), "v")
              .join(sets.select(F.col("node").alias("u"), F.col("items").alias("iu")), "u"))
    both = F.size(F.array_intersect("iu", "iv"))
    return (joined.select("u", "v", F.size("iu").alias("nu"), F.size("iv").alias("nv"), both.alias("both"))
            .filter(F.col("both") * 100 >= (F.col("nu") + F.col("nv") - F.col("both")) * PERCENT).select("u", "v"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    return _judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, h1, h2, n_shingles, component_id, kept."""
    rows = settle(signed(docs).withColumn("rid", F.monotonically_increasing_id()), "near-signed")
    key = ["h1", "h2", "n_shingles"]
    classes = settle(rows.filter("n_shingles > 0").groupBy(*key).agg(
        F.min("rid").alias("node"), F.min("doc_id").alias("doc"),
        F.min_by("bands", "rid").alias("bands"), F.min_by("bits", "rid").alias("bits")), "near-classes")

    band_rows = classes.select(F.explode("bands").alias("bucket"), "node")
    shared = settle(band_rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "near-buckets")
    members = settle(band_rows.join(shared, "bucket"), "near-members")
    facts = settle(classes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "doc", "h1", "h2", F.col("n_shingles").alias("n"),
        *[F.col("bits")[k].alias(f"g{k}") for k in range(2 * BIT_WORDS)]), "near-facts")
    brief = facts.select("node", "n", *[f"g{k}" for k in range(2 * BIT_WORDS)])

    def side(df: DataFrame, name: str, prefix: str) -> DataFrame:
        return brief.select(*[F.col(c).alias(name if c == "node" else prefix + c) for c in df.columns])

    def possible(pairs: DataFrame) -> DataFrame:
        wide = pairs.join(side(brief, "u", "u_"), "u").join(side(brief, "v", "v_"), "v")
        return wide.filter(_sizes_allow(F.col("u_n"), F.col("v_n")) & (_apart("u_", "v_") <= MAX_APART)).select("u", "v")

    # Each bucket's classes against its most central class.
    central = members.groupBy("node").agg(F.sum("m").alias("score"))
    leaders = (members.join(central, "node").groupBy("bucket")
               .agg((-F.max(F.struct("score", (-F.col("node")).alias("neg")))["neg"]).alias("leader")))
    stars = (members.join(leaders, "bucket").filter("node <> leader")
             .select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")).distinct())
    sets = settle(full_sets(docs, small_side(facts.select("node", "doc", "h1", "h2"), 32)), "near-sets")
    stars = settle(possible(stars), "near-stars")
    links = settle(_confirmed(stars, sets), "near-links")
    parts = components(links)

    # What is left: classes of different components that share a bucket.
    placed = (members.join(parts, "node", "left").withColumn("part", F.coalesce("part", F.col("node")))
              .select("bucket", "node", "m", "part"))
    counted = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("k"))
    largest = counted.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"),
                                            F.max(F.struct("k", "part"))["part"].alias("largest"))
    mixed = placed.join(largest.filter("parts > 1").drop("parts"), "bucket")
    buckets = mixed.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))  # at most one per band
    mixed = settle(mixed.join(brief, "node").join(buckets, "node"), "near-mixed")
    splits = F.ceil(F.col("m") / SPLIT).cast("int")
    outer = mixed.filter("part <> largest").select(
        "bucket", F.pmod(F.xxhash64("node"), splits).cast("int").alias("split"), F.col("node").alias("u"),
        F.col("part").alias("u_part"), F.col("buckets").alias("u_buckets"), *[F.col(c).alias(f"u_{c}") for c in brief.columns if c != "node"])
    inner = mixed.select(
        "bucket", F.explode(F.sequence(F.lit(0), splits - 1)).alias("split"), F.col("node").alias("v"),
        F.col("part").alias("v_part"), (F.col("part") == F.col("largest")).alias("v_largest"), F.col("buckets").alias("v_buckets"),
        *[F.col(c).alias(f"v_{c}") for c in brief.columns if c != "node"])
    crossed = outer.join(inner, ["bucket", "split"]).filter(
        (F.col("u_part") != F.col("v_part")) & (F.col("u") != F.col("v"))
        & _sizes_allow(F.col("u_n"), F.col("v_n")) & (_apart("u_", "v_") <= MAX_APART)
        & (F.array_min(F.array_intersect("u_buckets", "v_buckets")) == F.col("bucket")))
    crossed = crossed.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    crossed = settle(crossed.join(stars, ["u", "v"], "left_anti"), "near-crossed")
    more = settle(_confirmed(crossed, sets), "near-more")
    if not more.isEmpty():
        parts = components(links.unionByName(more))

    whole = classes.select(*key, "node", "doc").join(parts, "node", "left").withColumn("part", F.coalesce("part", F.col("node")))
    names = whole.groupBy("part").agg(F.min("doc").alias("component_id"))
    named = settle(whole.join(names, "part").select(*[F.col(k).alias(f"_{k}") for k in key], "component_id"), "near-named")
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("n_shingles") == F.col("_n_shingles"))
    joined = rows.select("doc_id", *key).join(named, same, "left")
    component = F.when(F.col("_h1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", *key, component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not kept, same columns.

    Rows go by doc_id; only where some rows of a doc_id are kept and others are
    not, the rows of these ids are signed again and go by id and text.  The ids
    are broadcast where they are counted to be few; whole rows are shuffled only
    beyond that.
    """
    with Scratch() as scratch:
        judged = scratch.keep(settle(_judged(docs).filter("doc_id IS NOT NULL").select("doc_id", "h1", "h2", "n_shingles", "kept").distinct(), "near-judged"))
    gone = judged.filter("NOT kept").withColumnsRenamed({"doc_id": "_gone", "h1": "_h1", "h2": "_h2", "n_shingles": "_n"}).drop("kept")
    ids = small_side(settle(gone.select("_gone").distinct(), "near-gone"), 24)
    out = packed(docs, "doc_id").join(ids, F.col("doc_id") == F.col("_gone"), "left_anti").select("_row.*")
    both = settle(judged.filter("kept").join(ids, F.col("doc_id") == F.col("_gone"), "left_semi").select(F.col("doc_id").alias("_both")).distinct(), "near-both")
    if both.isEmpty():
        return out
    again = settle(packed(docs, "doc_id", "text").join(both, F.col("doc_id") == F.col("_both"), "left_semi")
                   .withColumn("_rid", F.monotonically_increasing_id()), "near-again")
    signs = signed(again.select(F.col("_rid").alias("doc_id"), "text")).select(F.col("doc_id").alias("_id"), "h1", "h2", "n_shingles")
    same = ((F.col("doc_id") == F.col("_gone")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
            & (F.col("n_shingles") == F.col("_n")))
    return out.unionByName(again.join(signs, F.col("_rid") == F.col("_id")).join(gone, same, "left_anti").select("_row.*"))
