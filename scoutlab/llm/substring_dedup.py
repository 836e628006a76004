"""Suffix-array deduplication by a difference cover (operator 4).

Every byte covered by a LENGTH-byte string that also starts elsewhere is
removed.  The suffixes that matter are compared by their first LENGTH bytes, in
the manner of the difference-cover algorithm with period three:

1. Sampled suffixes - two of every three - are named by triples: a byte's name
   is its code, and the name of a 3**(k+1)-byte string is made from the names
   of its three parts of 3**k bytes.  Five levels of this recursion name 243
   bytes, and two of those names cover the rest.
2. A remaining suffix is its first byte and the name of the sampled suffix
   after it.
3. Suffixes are sorted by these names; adjacent ones with equal names have
   LENGTH bytes in common.

A name is 96 bits of hash made bottom-up from the text itself, not a rank in a
global sort.  Every task gives equal strings equal names without a shuffle per
level of the recursion; the order of names is total but not alphabetical, which
deduplication does not need.  (Ranks would need nine shuffles of all sampled
suffixes; see the README for what that costs.)

Positions of the cover are counted from anchors, not from the start of a
document: the anchor of a LENGTH-byte string is the smallest hash among its
GRAM-byte strings.  Equal strings have equal anchors at equal distances, so
equal suffixes are on the same side of the cover and one name for each suffices.

Two things keep the sorted volume near the size of what repeats:

* A string whose anchor occurs nowhere else occurs nowhere else.  Anchors are
  counted over all texts; only suffixes with repeated anchors are sorted.
* Neighbouring suffixes with one anchor form a piece.  Pieces of equal bytes
  are counted, with partial aggregation, and sorted once with their count: a
  piece that occurs twice makes each of its suffixes a repeat.

Anchors with many different pieces are split over tasks by name, and equal
names met within one task travel on as one.

Texts are UTF-8 bytes; null is empty.  Texts shorter than LENGTH lose nothing.
Strings never cross documents.  Rows that repeat a text are separate documents
and lose all of it if it has LENGTH bytes.  doc_id is only passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scoutlab.llm.common import settle
from scoutlab.llm.shingles import mix, powers

LENGTH = 400
GRAM = 200
SPAN = LENGTH - GRAM + 1  # starts of grams in a string
# Bytes handled together in a task; longer texts are cut with an overlap.
CHUNK = 1 << 18
# Bytes of text that are named together, and suffixes that are merged together.
NAMED = 1 << 17
# Suffixes expected in one sorted bucket, and pieces of one anchor that are
# sorted together before its names are split.
BUCKET = 1 << 18
ANCHOR_PIECES = 2000
_U = np.uint64
_BASE = 0xD1342543DE82EF95
_ONES = _U(2**64 - 1)
_INDEX_BITS = 21  # positions in a chunk and its overlap
_LANES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_CODES = mix(np.arange(1, 257, dtype=_U) * _U(0x2545F4914F6CDD1D))


def segments(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, first byte, row, offset in the row's text) of chunks of whole or cut texts."""
    data, first, rows, offsets, held = [], [], [], [], 0
    texts = texts.cast(pa.large_binary())
    for i, value in enumerate(texts):
        text = np.frombuffer(value.as_py() or b"", np.uint8)
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            part = text[at:at + CHUNK + LENGTH - 1]
            if held and held + len(part) > CHUNK + LENGTH:
                yield np.concatenate(data), np.array(first), np.array(rows), np.array(offsets)
                data, first, rows, offsets, held = [], [], [], [], 0
            first.append(held)
            rows.append(i)
            offsets.append(at)
            data.append(part)
            held += len(part)
    if held:
        yield np.concatenate(data), np.array(first), np.array(rows), np.array(offsets)


def _rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes."""
    n = len(data)
    prefix = np.zeros(n + 1, _U)
    np.cumsum(_CODES[data] * powers(_BASE, n), out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * powers(pow(_BASE, -1, 1 << 64), n - width + 1))


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, _ONES, _U)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchored(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings with one anchor: (start, number of strings,
    anchor's position, anchor's name)."""
    grams = _rolling(data, GRAM)
    index = np.arange(len(grams), dtype=_U)
    low = _U((1 << _INDEX_BITS) - 1)
    best = _window_minimum((grams & ~low) | index, SPAN)
    anchor = (best & low).astype(np.int64)
    ends = np.r_[first[1:], len(data)]
    inside = np.zeros(len(anchor) + 1, np.int32)
    np.add.at(inside, first, 1)
    np.add.at(inside, np.minimum(ends - LENGTH + 1, len(anchor)), -1)
    valid = np.cumsum(inside[:-1]) > 0
    change = np.r_[True, (anchor[1:] != anchor[:-1]) | ~valid[:-1]]
    change[first] = True
    starts = np.flatnonzero(change & valid)
    # A run ends where another starts or the valid positions end.
    stops = np.flatnonzero(valid & np.r_[change[1:] | ~valid[1:], True]) + 1
    at = anchor[starts]
    return starts, stops - starts, at, grams[at]


def suffix_names(data: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per lane, names of the LENGTH-byte and the (LENGTH - 1)-byte string at
    every position that has one, by recursion on triples."""
    out = []
    for a, b, c in _LANES:
        names, width = mix(_CODES[data] ^ _U(a)), 1
        for _ in range(5):
            n = len(names) - 2 * width
            names = mix(names[:n] * _U(a) + names[width:width + n] * _U(b) + names[2 * width:2 * width + n] * _U(c))
            width *= 3
        pair = []
        for length in (LENGTH, LENGTH - 1):
            step = length - width
            pair.append(mix(names[:len(names) - step] * _U(b) + names[step:] * _U(c) + _U(length)))
        out.append(tuple(pair))
    return out


def cover_keys(data: np.ndarray, at: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96-bit sort keys of the suffixes at ``at`` in ``data``; ``distance``: to their anchors."""
    sampled = distance % 3 != 0
    keys = []
    for whole, short in suffix_names(data):
        merged = mix(short[at + 1] * _U(257) + data[at].astype(_U) + _U(1))
        keys.append(np.where(sampled, whole[at], merged))
    return keys[0], (keys[1] >> _U(32)).astype(np.uint32)


def _text_key(text: Column) -> tuple[Column, Column]:
    """128 bits of hash that stand for a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(17), text)


def _pieces_of(data, first, rows, offsets, wanted=None):
    """Pieces of a chunk whose anchor's name is in its row's ``wanted`` names."""
    starts, counts, at, names = anchored(data, first)
    owner = np.searchsorted(first, starts, "right") - 1
    if wanted is not None:
        keep = np.zeros(len(starts), bool)
        bounds = np.searchsorted(owner, np.arange(len(first) + 1))
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            keep[a:b] = np.isin(names[a:b], wanted[rows[i]])
        starts, counts, at, names, owner = starts[keep], counts[keep], at[keep], names[keep], owner[keep]
    return starts, counts, at, names, owner


def anchors(texts: DataFrame) -> DataFrame:
    """k1, k2, name, n: the anchors of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for data, first, rows, offsets in segments(batch.column(2)):
                _, _, _, names, owner = _pieces_of(data, first, rows, offsets)
                row = rows[owner]
                order = np.lexsort((names, row))
                row, names = row[order], names[order]
                new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (names[1:] != names[:-1])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[row[new]]), pa.array(k2[row[new]]), pa.array(names[new].view(np.int64)),
                     pa.array(np.diff(np.r_[new, len(row)]))], names=["k1", "k2", "name", "n"])

    return texts.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, name long, n long")


def pieces(candidates: DataFrame) -> DataFrame:
    """k1, k2, copies, start, m (suffixes), distance (of the first to its
    anchor), anchor, h1, h2 (128 bits of the piece's bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, copies = (batch.column(i).to_numpy() for i in (0, 1, 2))
            wanted = [np.array(x, np.int64).view(_U) for x in batch.column(4).to_pylist()]
            for data, first, rows, offsets in segments(batch.column(3)):
                starts, counts, at, names, owner = _pieces_of(data, first, rows, offsets, wanted)
                if not len(starts):
                    continue
                hashes = []
                for base in (_BASE, 0xBF58476D1CE4E5B9):
                    prefix = np.zeros(len(data) + 1, _U)
                    np.cumsum(_CODES[data] * powers(base, len(data)), out=prefix[1:])
                    raw = (prefix[starts + counts + LENGTH - 1] - prefix[starts]) * powers(pow(base, -1, 1 << 64), len(data))[starts]
                    hashes.append(mix(raw + (at - starts).astype(_U) * _U(0x9FB21C651E98DF25)).view(np.int64))
                row = rows[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[row]), pa.array(k2[row]), pa.array(copies[row]), pa.array(starts - first[owner] + offsets[owner]),
                     pa.array(counts), pa.array(at - starts), pa.array(names.view(np.int64)), *map(pa.array, hashes)],
                    names=["k1", "k2", "copies", "start", "m", "distance", "anchor", "h1", "h2"])

    return candidates.select("k1", "k2", "copies", "text", "names").mapInArrow(
        run, "k1 long, k2 long, copies long, start long, m long, distance long, anchor long, h1 long, h2 long")


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the first byte of each and their end."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8), offsets


def _list_fields(lists: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Row and fields of every struct in a column of lists."""
    items = lists.flatten()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return row, dict(zip((f.name for f in items.type), items.flatten()))


def _binaries(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """``values`` cut at ``edge`` (from 0) into binary values."""
    offsets = (np.r_[edge, len(values)] * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _named_blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """Keys (high, low) of the suffixes of a batch's pieces, their numbers in
    their pieces, and the pieces; NAMED bytes of text at a time.

    Neighbouring pieces overlap by LENGTH - 1 bytes, which are named once.
    """
    data, offsets = _text_bytes(batch.column(0))
    row, fields = _list_fields(batch.column(1))
    if not len(row):
        return
    fields = {name: x.to_numpy(zero_copy_only=False) for name, x in fields.items()}
    a = offsets[row] + fields["start"]
    order = np.argsort(a, kind="stable")
    a, fields = a[order], {name: x[order] for name, x in fields.items()}
    b = a + fields["m"] + LENGTH - 1
    apart = np.r_[True, a[1:] > b[:-1]]
    block = np.cumsum(fields["m"] + LENGTH * apart) // NAMED
    edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for i, j in zip(edge, np.r_[edge[1:], len(a)]):
        first = np.flatnonzero(np.r_[True, apart[i + 1:j]])
        begins, ends = a[i:j][first], b[i:j][np.r_[first[1:], j - i] - 1]
        text = np.concatenate([data[x:y] for x, y in zip(begins, ends)])
        shift = np.cumsum(ends - begins) - (ends - begins) - begins
        own = {name: x[i:j] for name, x in fields.items()}
        size = own["m"]
        at = a[i:j] + np.repeat(shift, np.diff(np.r_[first, j - i]))
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        high, low = cover_keys(text, np.repeat(at, size) + offset, np.repeat(own["distance"], size) - offset)
        yield high, low, offset.astype("<u2"), own


def _travelling(parts: list, buckets: int) -> Iterator[pa.RecordBatch]:
    """bucket, piece, at, high, low: suffixes whose name repeats in ``parts`` (no
    keys), and one suffix of every name with its keys."""
    high, low, offset = (np.concatenate([x[i] for x in parts]) for i in range(3))
    of = {name: np.concatenate([x[3][name] for x in parts]) for name in parts[0][3]}
    piece = np.repeat(np.arange(len(of["m"]), dtype=np.int32), of["m"])
    # Equal names within the task: all are repeats, and one travels on.
    order = np.lexsort((low, high))
    high_, low_ = high[order], low[order]
    new = np.r_[True, (high_[1:] != high_[:-1]) | (low_[1:] != low_[:-1])]
    del high_, low_
    total = np.add.reduceat(of["weight"][piece[order]], np.flatnonzero(new))
    repeat = np.zeros(len(piece), bool)
    repeat[order] = (total > 1)[np.cumsum(new) - 1]
    travels = np.zeros(len(piece), bool)
    travels[order] = new
    del order, new, total

    def rows(mask: np.ndarray, with_keys: bool) -> Iterator[pa.RecordBatch]:
        chosen = np.flatnonzero(mask)
        if not len(chosen):
            return
        split = high[chosen] % of["splits"].astype(_U)[piece[chosen]]
        bucket = (mix(of["anchor"].view(_U)[piece[chosen]] + split * _U(0x9E3779B97F4A7C15)) % _U(buckets)).astype(np.int64)
        if with_keys:
            order = np.lexsort((bucket, piece[chosen]))
            chosen, bucket = chosen[order], bucket[order]
        own = piece[chosen]
        edge = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (with_keys & (bucket[1:] != bucket[:-1]))])
        keys = [_binaries(x[chosen], edge) if with_keys else pa.nulls(len(edge), pa.binary()) for x in (high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[edge]), pa.array(of["piece"][own[edge]]), _binaries(offset[chosen], edge), *keys],
                                         names=["bucket", "piece", "at", "high", "low"])

    yield from rows(repeat, False)
    yield from rows(travels, True)


def repeated_suffixes(work: DataFrame, buckets: int) -> DataFrame:
    """piece, at: the suffixes (numbers within their piece) that are repeats.

    ``work``: text and its representative pieces (list of piece, start, m,
    distance, anchor, weight, splits).
    """
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in _named_blocks(batch):
                held.append(part)
                n += len(part[0])
                if n > 2 * BUCKET:
                    yield from _travelling(held, buckets)
                    held, n = [], 0
        if held:
            yield from _travelling(held, buckets)

    def adjacent(rows: pd.DataFrame) -> pd.DataFrame:
        done = rows[rows["high"].isna()]
        rows = rows[rows["high"].notna()]
        sizes = rows["at"].map(len).to_numpy() // 2
        row = np.repeat(np.arange(len(rows)), sizes)
        at = np.frombuffer(b"".join(rows["at"]), "<u2")
        high, low = np.frombuffer(b"".join(rows["high"]), _U), np.frombuffer(b"".join(rows["low"]), np.uint32)
        order = np.lexsort((low, high))
        same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
        repeat = np.zeros(len(at), bool)
        repeat[order] = np.r_[False, same] | np.r_[same, False]
        chosen = np.flatnonzero(repeat)
        edge = np.flatnonzero(np.r_[True, row[chosen][1:] != row[chosen][:-1]]) if len(chosen) else np.empty(0, int)
        ends = np.r_[edge[1:], len(chosen)] if len(edge) else edge
        ids = rows["piece"].to_numpy()
        found = pd.DataFrame({"piece": ids[row[chosen[edge]]] if len(edge) else np.empty(0, np.int64),
                              "at": [at[chosen[a:b]].tobytes() for a, b in zip(edge, ends)]})
        return pd.concat([done[["piece", "at"]], found])

    keyed = work.select("text", "list").mapInArrow(named, "bucket long, piece long, at binary, high binary, low binary")
    return keyed.groupBy("bucket").applyInPandas(adjacent, "piece long, at binary")


def _merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals [a, b): its maximal intervals, in order."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
    return a[first], b[np.r_[first[1:], len(b)] - 1]


def _covered(row: np.ndarray, fields: dict[str, pa.Array], base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that repeated suffixes cover, NAMED suffixes at a time."""
    begin = base[row] + fields["start"].to_numpy(zero_copy_only=False)
    ats = fields["ats"]
    whole = ats.is_null().to_numpy(zero_copy_only=False)
    found = [(begin[whole], begin[whole] + fields["m"].to_numpy(zero_copy_only=False)[whole] + LENGTH - 1)]
    values = ats.flatten()
    owner = np.repeat(begin, ats.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    data, offsets = _text_bytes(values)
    sizes = np.diff(offsets) // 2
    edge = np.flatnonzero(np.diff(np.r_[-1, np.cumsum(sizes) // NAMED]))
    for i, j in zip(edge, np.r_[edge[1:], len(sizes)]):
        at = np.repeat(owner[i:j], sizes[i:j]) + np.frombuffer(data[offsets[i]:offsets[j]].tobytes(), "<u2")
        found.append(_merged(at, at + LENGTH))
    return _merged(*(np.concatenate(x) for x in zip(*found)))


def removals(work: DataFrame) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept_sha256 of texts with their repeated
    suffixes (list of start, m, ats; no ats: all m)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _text_bytes(batch.column(2))
            # A byte lies between rows here, so that no span crosses them.
            base = offsets[:-1] + np.arange(batch.num_rows)
            begins, ends = _covered(*_list_fields(batch.column(3)), base)
            bounds = np.searchsorted(begins, np.r_[base, offsets[-1] + batch.num_rows])
            gone = np.r_[0, np.cumsum(ends - begins)]
            kept = []
            for i in range(batch.num_rows):
                rest, at = hashlib.sha256(), offsets[i]
                for x, y in zip(begins[bounds[i]:bounds[i + 1]] - i, ends[bounds[i]:bounds[i + 1]] - i):
                    rest.update(data[at:x])
                    at = y
                rest.update(data[at:offsets[i + 1]])
                kept.append(rest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(gone[bounds])), pa.array(np.diff(bounds)), pa.array(kept, pa.string())],
                names=["k1", "k2", "n_removed", "n_spans", "kept_sha256"])

    return work.select("k1", "k2", "text", "list").mapInArrow(run, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string")


def substring_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col("text"), F.lit(""))
    k1, k2 = _text_key(text)
    keyed = docs.select("doc_id", text.alias("text"), k1.alias("k1"), k2.alias("k2"))
    long = keyed.filter(F.octet_length("text") >= LENGTH)
    key = ["k1", "k2"]

    # Anchors that occur more than once, and the texts that have them.
    found = settle(anchors(long), "substring-anchors")
    shared = found.groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name")
    names = found.join(shared, "name").groupBy(*key).agg(F.collect_set("name").alias("names"))
    texts = long.groupBy(*key).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    candidates = settle(texts.join(names, key), "substring-texts")

    # Pieces of equal bytes are sorted once.
    every = settle(pieces(candidates), "substring-pieces")
    shape = ["anchor", "h1", "h2", "m"]
    kinds = settle(every.groupBy(*shape).agg(F.sum("copies").alias("weight"), F.min("distance").alias("distance"),
                                             F.min(F.struct("k1", "k2", "start")).alias("first"))
                   .withColumn("piece", F.monotonically_increasing_id()), "substring-kinds")
    splits = kinds.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / ANCHOR_PIECES).cast("long").alias("splits"))
    suffixes = kinds.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    jobs = (kinds.join(splits, "anchor").select("first.k1", "first.k2", F.struct(
        "piece", F.col("first.start").alias("start"), "m", "distance", "anchor", F.least("weight", F.lit(2)).alias("weight"), "splits").alias("x"))
        .groupBy(*key).agg(F.collect_list("x").alias("list")))
    repeats = repeated_suffixes(candidates.select(*key, "text").join(jobs, key), suffixes // BUCKET + 1)
    flags = settle(repeats.groupBy("piece").agg(F.collect_list("at").alias("ats")), "substring-repeats")

    # Back to the texts.
    marked = kinds.join(flags, "piece", "left").filter((F.col("weight") > 1) | F.col("ats").isNotNull()).select(
        *shape, F.when(F.col("weight") > 1, F.lit(None)).otherwise(F.col("ats")).alias("ats"))
    hits = (every.join(marked, shape).groupBy(*key)
            .agg(F.collect_list(F.struct("start", "m", "ats")).alias("list")))
    changed = settle(removals(candidates.select(*key, "text").join(hits, key)), "substring-removals")
    changed = changed.withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    whole = keyed.select("doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return whole.join(changed, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
