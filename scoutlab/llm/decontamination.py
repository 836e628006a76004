"""Benchmark decontamination by a generalised suffix automaton (operator 13).

Words are runs of digits, letters a-z and non-ASCII characters after lower-casing
A-Z.  The automaton accepts every substring of every test item's words.  A
document's words are streamed through it; the state reached gives the longest
suffix read so far that occurs in an item.  Where that is at least ``window``
words long, the last ``window`` words are an occurrence of a window, and its
state names the items that hold it.  An item of fewer words (but not none) is one
window: the whole item is the longest string of its state, so it ends here if
that state is the current one at full length or one of its suffix links.

Items are put into blocks of about BLOCK_WORDS words, by hash; longer items are
cut into parts that overlap by ``window`` - 1 words, which keeps every window.
Executors build one automaton per block.  What a pass over the documents
broadcasts is bounded whatever the benchmark's size: PASS_BLOCKS automata; a
larger benchmark takes further passes, and each pass adds its spans and items
to those before.  Documents are never shuffled.

A word unknown to the block, or a pair of neighbours that no item has (looked up
in a bit table that may err on the safe side), ends every match: stretches too
short for the shortest window are not streamed.

Null and empty texts have no words: such items give nothing and such documents
are clean.  Repeated items, and rows that share an item_id, count once per id;
windows of an item without an id hit words but name no item.  Repeated
documents and null doc_ids are rows like any other.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from scoutlab.llm.common import packed, settle

WINDOW = 10
BLOCK_WORDS = 1 << 17
PART_WORDS = 1 << 12
PASS_BLOCKS = 4
CHUNK_WORDS = 1 << 18
PAIR_BITS = 22
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


class Automaton:
    """Generalised suffix automaton of lists of words."""

    def __init__(self, window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of the strings of p followed by ``word``, cut off from q."""
        if self.length[q] == self.length[p] + 1:
            return q
        new = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = new
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new

    def add(self, text: list[bytes]) -> None:
        last = 0
        for w in text:
            last = self._extend(last, self.words.setdefault(w, len(self.words)))

    def finish(self, items: list[tuple[str | None, list[bytes]]]) -> dict:
        """What a pass needs of the automaton, given the (name, words) it was built from."""
        states, window = len(self.link), self.window
        gram, short = [-1] * states, [-1] * states
        for v in sorted(range(1, states), key=self.length.__getitem__):
            if self.length[v] >= window:
                up = self.link[v]
                gram[v] = v if self.length[up] < window else gram[up]
        owners: dict[int, set[str]] = {}
        pairs = np.zeros(1 << PAIR_BITS, bool)
        wholes = set()
        for name, text in items:
            v, ids = 0, np.array([self.words[w] for w in text], np.int64)
            pairs[_pair(ids[:-1], ids[1:])] = True
            for i, word in enumerate(ids.tolist()):
                v = self.next[v][word]
                if i >= window - 1:
                    owners.setdefault(gram[v], set()).update([name] if name is not None else [])
            if 0 < len(text) < window:
                wholes.add(v)
                owners.setdefault(v, set()).update([name] if name is not None else [])
        for v in sorted(range(1, states), key=self.length.__getitem__):
            short[v] = v if v in wholes else short[self.link[v]]
        edges = np.array([(v, w, u) for v, out in enumerate(self.next) for w, u in out.items()], np.int64).reshape(-1, 3)
        return {"window": window, "least": min([window] + [self.length[v] for v in wholes]), "words": self.words,
                "keys": edges[:, 0] * max(1, len(self.words)) + edges[:, 1], "to": edges[:, 2].astype(np.int32),
                "link": np.array(self.link, np.int32), "length": np.array(self.length, np.int32),
                "gram": np.array(gram, np.int32), "short": np.array(short, np.int32),
                "owners": {v: sorted(names) for v, names in owners.items()}, "pairs": np.packbits(pairs)}


def build(items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> dict:
    """The finished automaton of (name, words) items."""
    automaton = Automaton(window)
    for _, text in items:
        automaton.add(text)
    return automaton.finish(items)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * 0x9E3779B1 + b * 0x85EBCA77) & 0xFFFFFFFF
    return (h ^ (h >> 15)) & ((1 << PAIR_BITS) - 1)


class Reader:
    """A finished automaton as a task uses it."""

    def __init__(self, made: dict):
        self.window, self.least, self.words = made["window"], made["least"], made["words"]
        self.size = max(1, len(self.words))
        self.next = dict(zip(made["keys"].tolist(), made["to"].tolist()))
        self.link, self.length = made["link"].tolist(), made["length"].tolist()
        self.gram, self.short, self.owners = made["gram"].tolist(), made["short"].tolist(), made["owners"]
        self.pairs = np.unpackbits(made["pairs"]).view(bool)

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of ``ids`` (unknown words are negative) that may hold a match of a window."""
        known = ids >= 0
        if self.least == 1:
            flags, extra = known, 0
        else:
            flags, extra = known[:-1] & known[1:], 1
            flags[flags] = self.pairs[_pair(ids[:-1][flags], ids[1:][flags])]
        padded = np.zeros(len(flags) + 2, np.int8)
        padded[1:-1] = flags
        edges = np.flatnonzero(np.diff(padded))
        a, z = edges[::2], edges[1::2] + extra
        long = z - a >= self.least
        return list(zip(a[long].tolist(), z[long].tolist()))

    def matches(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(first word, end, matching length, state) of every occurrence of a window."""
        out = []
        step, link, length, gram, short = self.next.get, self.link, self.length, self.gram, self.short
        size, window = self.size, self.window
        for a, z in self.stretches(ids):
            v = n = 0
            for i, word in enumerate(ids[a:z].tolist(), a + 1):
                u = step(v * size + word)
                while u is None and v:
                    v = link[v]
                    n = length[v]
                    u = step(v * size + word)
                if u is None:
                    n = 0
                    continue
                v, n = u, n + 1
                if n >= window:
                    out.append((i - window, i, n, gram[v]))
                w = short[v if n == length[v] else link[v]] if v else -1
                while w > 0:
                    out.append((i - length[w], i, n, w))
                    w = short[link[w]]
        return out


def _parts(benchmark: DataFrame, window: int) -> DataFrame:
    """item, words (joined by spaces), n: distinct items, long ones in overlapping parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(PART_WORDS, 2 * window) - window + 1
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = words_of(text.as_py())
                for a in range(0, max(1, len(words) - window + 1), step):
                    part = words[a:a + step + window - 1]
                    if part:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name], pa.string()), pa.array([b" ".join(part)], pa.binary()), pa.array([len(part)], pa.int64())],
                            ["item", "words", "n"])

    named = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    return named.mapInArrow(run, "item string, words binary, n long")


def automata(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, int]:
    """block, automaton (a finished automaton, pickled): built on executors, one row
    per block; and the number of blocks."""
    parts = settle(_parts(benchmark, window), "benchmark-parts")
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))

    def run(table: pa.Table) -> pa.Table:
        items = [(name, text.split(b" ")) for name, text in zip(table["item"].to_pylist(), table["words"].to_pylist())]
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()),
                         "automaton": pa.array([pickle.dumps(build(items, window))], pa.binary())})

    put = parts.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int"))
    made = put.groupBy("block").applyInArrow(run, "block int, automaton binary")
    return settle(made, "benchmark-automata"), blocks


def _joined(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (start, end, longest match) that overlap or touch, made one."""
    out: list[list[int]] = []
    for a, z, n in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1], out[-1][2] = max(out[-1][1], z), max(out[-1][2], n)
        else:
            out.append([a, z, n])
    return [tuple(s) for s in out]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("longest", pa.int64())]))


def _pass(given: Broadcast, again: bool):
    """mapInArrow body: adds the spans and items of the broadcast automata."""
    def chunk(readers: list[Reader], texts: list[list[bytes]], spans: list, items: list) -> None:
        sizes = [len(t) + 1 for t in texts]  # an unknown word ends every document
        ends = np.cumsum(sizes)
        for reader in readers:
            get = reader.words.get
            ids = np.full(int(ends[-1]), -1, np.int64)
            for t, z in zip(texts, ends.tolist()):
                ids[z - 1 - len(t):z - 1] = list(map(get, t, repeat(-1)))
            found = reader.matches(ids)
            owner = np.searchsorted(ends, [m[0] for m in found], "right").tolist()
            for doc, (a, z, n, state) in zip(owner, found):
                first = int(ends[doc]) - sizes[doc]
                if spans[doc] and spans[doc][-1][0] <= a - first <= spans[doc][-1][1]:  # as nearly always: further along
                    b, y, most = spans[doc][-1]
                    spans[doc][-1] = (b, max(y, z - first), max(most, n))
                else:
                    spans[doc].append((a - first, z - first, n))
                items[doc].add(state)
            for names in items:
                states = [s for s in names if isinstance(s, int)]
                if states:
                    names.difference_update(states)
                    for s in states:
                        names.update(reader.owners[s])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(pickle.loads(made)) for made in given.value]
        for batch in batches:
            raw = batch.column("text").cast(pa.binary())
            row = 0
            while row < batch.num_rows:
                first, held, n = row, [], 0
                while row < batch.num_rows and (not held or n < CHUNK_WORDS):
                    held.append(words_of(raw[row].as_py()))
                    n += len(held[-1])
                    row += 1
                spans, items = [[] for _ in held], [set() for _ in held]
                if again:
                    for k, (old, names) in enumerate(zip(batch.column("spans").slice(first, row - first).to_pylist(),
                                                         batch.column("items").slice(first, row - first).to_pylist())):
                        spans[k] = [(s["start"], s["start"] + s["length"], s["longest"]) for s in old]
                        items[k] = set(names)
                chunk(readers, held, spans, items)
                joined = [[{"start": a, "length": z - a, "longest": n} for a, z, n in _joined(s)] for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(first, row - first), batch.column("text").slice(first, row - first),
                     pa.array([len(w) for w in held], pa.int64()), pa.array(joined, _SPANS),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    ["_row", "text", "n_words", "spans", "items"])
    return run


def matched(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``rows`` (_row, text) with n_words, spans and items.

    ``spans``: the maximal stretches of hit words (start, length in words) with the
    longest matching length met in each; ``items``: the names of the items whose
    windows occur, as sorted strings.
    """
    made, blocks = automata(benchmark, window)
    kind = rows.schema["_row"].dataType.simpleString()
    schema = (f"_row {kind}, text string, n_words long, "
              "spans array<struct<start: long, length: long, longest: long>>, items array<string>")
    spark = rows.sparkSession
    for a in range(0, blocks, PASS_BLOCKS):
        held = [bytes(r["automaton"]) for r in made.filter(F.col("block").between(a, a + PASS_BLOCKS - 1)).orderBy("block").collect()]
        if a:
            rows = settle(rows, "decontamination-pass")
        rows = rows.mapInArrow(_pass(spark.sparkContext.broadcast(held), a > 0), schema)
    return rows


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans, items."""
    rows = docs.select(F.struct("doc_id").alias("_row"), "text")
    found = matched(rows, benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("_row.doc_id", "n_words", hit.alias("n_hit"), "spans", "items")


def _cut(longer_than: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").cast(pa.binary()), batch.column("spans").to_pylist()):
                data = text.as_py()
                gone = [s for s in spans if s["length"] > longer_than]
                if gone:
                    places = [m.span() for m in _WORD.finditer(data.lower())]
                    kept, at = [], 0
                    for s in gone:
                        kept.append(data[at:places[s["start"]][0]])
                        at = places[s["start"] + s["length"] - 1][1]
                    data = b"".join(kept) + data[at:]
                texts.append(data)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.binary()).cast(pa.string())], ["_row", "text"])
    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   longest_span: int = 0, coverage_permille: int = 200) -> DataFrame:
    """``docs`` without leaked passages, same columns.

    Documents with more than ``coverage_permille`` of their words hit go; from the
    others spans of more than ``longest_span`` words are removed, from the first
    character of their first word to the last of their last.
    """
    found = matched(packed(docs, "text"), benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    low = found.filter(hit * 1000 <= F.col("n_words") * coverage_permille)
    kind = found.schema["_row"].dataType.simpleString()
    cut = low.select("_row", "text", "spans").mapInArrow(_cut(longest_span), f"_row {kind}, text string")
    return cut.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])
