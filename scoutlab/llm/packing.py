"""Vector bin packing of token sequences (operator 2).

A piece has a vector of tokens, segments (one) and loss-bearing tokens, and a
sequence has a limit on each.  A task fills one sequence at a time: of the
pieces in its pool that fit, it takes the one with the largest dot product of
the piece's vector and the sequence's remaining room, both as shares of the
limits (the bin-centric dot-product heuristic).  When none fits, the piece with
the largest dot product is cut to the room that is left, and its rest goes back
to the pool.  A sequence that cannot be filled - out of segments, or at the
end of the task's rows - is closed at the largest power of two of its tokens
by cutting the piece that crosses it, so that it needs no padding.

Tasks pack the rows of their own partition: no shuffle, and a pool of at most
POOL pieces in memory.  Pieces carry the partition's number in their sequence
id, so a task that is run again makes the same rows.

Null text packs as empty: its end id alone.  Every id lies in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

CAPACITY = 4096
MAX_SEGMENTS = 128
POOL = 256
END_ID = 2
# Words whose ids a Python worker remembers (some 200 bytes each) before it
# forgets them all.
MEMORY = 1_000_000
# Characters of text whose unknown words are learnt together.
LEARN_CHARS = 1 << 19
# Sequence numbers per partition.
PARTITION_BITS = 36


class WordIds:
    """Token ids of texts, with the ids of seen words remembered.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words in order.  Words are cut at ASCII spaces and
    line ends only; any other white space stays in a word and is left to the
    tokenizer.  The file's added tokens written out in a text are plain text with
    ``literal``; without it, as in the packing, they are what the file says.
    """

    def __init__(self, path: str, literal: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        # For ASCII letters the file's normalizer only lower-cases and its
        # splitter keeps a word whole, so they need the model alone.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.tails = {"": b"", **{x: self.encoded(x) for x in ".,"}}
        self.known: dict[str, bytes] = {"": b""}

    def encoded(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids, "<u4").tobytes()

    @classmethod
    def shared(cls, path: str) -> WordIds:
        """The one of this process: a Python worker serves many tasks, and
        words learnt in one need not be learnt in the next."""
        import sys

        held = sys.__dict__.setdefault("_word_ids", {})
        if path not in held:
            held[path] = cls(path, literal=False)
        return held[path]

    def _learn_groups(self, tokenizer, words: list[str]) -> None:
        """Words that make one token group each: many are encoded as one text
        and cut apart at the group ends."""
        for at in range(0, len(words), 256):
            some = words[at:at + 256]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                raw, begin = ids.tobytes(), 0
                for w, end in zip(some, (4 * cuts).tolist()):
                    self.known[w] = raw[begin:end]
                    begin = end

    def learn(self, new: list[str]) -> None:
        known = self.known
        parts = {}
        for w in new:
            tail = w[-1] if w[-1] in ".," else ""
            stem = w[:-1] if tail else w
            if stem.isalpha() and max(stem) < "\u0130":  # no normal form changes these letters
                parts[w] = stem.lower(), tail
        stems = {stem for stem, _ in parts.values() if stem not in known}
        self._learn_groups(self.letters, [x for x in stems if x.isascii()])
        self._learn_groups(self.tokenizer, [x for x in stems if not x.isascii()])
        for w, (stem, tail) in parts.items():
            if stem in known:
                known[w] = known[stem] + self.tails[tail]
        for w in new:
            if w not in known:
                known[w] = self.encoded(w)

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text with END_ID after them; unknown words of all texts are learnt at once."""
        end = np.array([END_ID], "<u4").tobytes()
        split = [(t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self.known) > MEMORY:
            self.known = {"": b""}
        known = self.known
        self.learn([w for w in set().union(*split) if w not in known])
        for words in split:
            yield np.frombuffer(b"".join([known[w] for w in words]) + end, "<u4")


class Packer:
    """Packs pieces of one task; ``emit`` gets (piece, sequence number, offset)."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int):
        self.limits = np.array([capacity, max_segments, max_loss], float)
        self.capacity, self.max_segments, self.max_loss = capacity, max_segments, max_loss
        self.items: list[tuple] = []  # (key, ids, start, doc_tokens, bears_loss)
        self.vectors = np.zeros((0, 3))
        self.sequence = 0

    def add(self, items: list[tuple]) -> None:
        more = np.array([[len(x[1]), 1, len(x[1]) * x[4]] for x in items], float).reshape(-1, 3)
        self.items += items
        self.vectors = np.concatenate([self.vectors, more])

    def _take(self, i: int, n: int | None = None) -> tuple:
        """Remove piece i from the pool, or only its first n tokens."""
        key, ids, start, total, loss = self.items[i]
        if n is None or n >= len(ids):
            last = self.items.pop()
            row = self.vectors[-1]
            if i < len(self.items):
                self.items[i], self.vectors[i] = last, row
            self.vectors = self.vectors[:-1]
            return key, ids, start, total, loss
        self.items[i] = (key, ids[n:], start + n, total, loss)
        self.vectors[i] = (len(ids) - n, 1, (len(ids) - n) * loss)
        return key, ids[:n], start, total, loss

    def fill(self) -> list[tuple]:
        """One sequence: rows of (key, ids, start, doc_tokens, sequence, offset)."""
        room, chosen = self.limits.copy(), []
        while self.items and room[0] > 0 and room[1] > 0:
            score = (self.vectors / self.limits) @ (room / self.limits)
            fits = (self.vectors <= room).all(1)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                piece = self._take(i)
            else:
                # Nothing fits whole; a piece that bears loss is cut to the
                # smaller of both rooms, another to the room for tokens.
                allowed = np.where(self.vectors[:, 2] > 0, min(room[0], room[2]), room[0])
                i = int(np.argmax(np.where(allowed > 0, score, -1.0)))
                if allowed[i] <= 0:
                    break
                piece = self._take(i, int(allowed[i]))
            n = len(piece[1])
            room -= (n, 1, n * piece[4])
            chosen.append(piece)
        length = sum(len(x[1]) for x in chosen)
        back: list[tuple] = []
        if length < self.capacity:
            keep, at, kept = 1 << (length.bit_length() - 1), 0, []
            for key, ids, start, total, loss in chosen:
                n = min(len(ids), keep - at)
                if n:
                    kept.append((key, ids[:n], start, total, loss))
                if n < len(ids):
                    back.append((key, ids[n:], start + n, total, loss))
                at += n
            chosen = kept
        rows, at = [], 0
        for key, ids, start, total, _ in chosen:
            rows.append((key, ids, start, total, self.sequence, at))
            at += len(ids)
        if back:
            self.add(back)
        self.sequence += 1
        return rows


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", bears_loss: str = "true",
         capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = CAPACITY) -> DataFrame:
    """Pack ``docs`` into sequences within the three limits.

    ``tokenizer``: path of the tokenizer file, present on every executor.
    ``bears_loss``: SQL condition that tells whether a row's tokens bear loss
    (all of a document's, an assistant's turns of a conversation).
    Returns per piece: key, start, length, ids (little-endian 32-bit, binary),
    doc_tokens, sequence_id, offset.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                       F.coalesce(F.expr(bears_loss), F.lit(False)).alias("loss"))
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << PARTITION_BITS
        word_ids, packer = WordIds.shared(tokenizer), Packer(capacity, max_segments, max_loss)
        out: list[tuple] = []
        held = 0

        def encoded(texts: pa.Array) -> Iterator[np.ndarray]:
            some, size = [], 0
            for text in texts:
                some.append(text.as_py())
                size += len(some[-1] or "")
                if size > LEARN_CHARS:
                    yield from word_ids(some)
                    some, size = [], 0
            yield from word_ids(some)

        def batch() -> pa.RecordBatch:
            columns = zip(*[(k, start, len(ids), ids.tobytes(), total, base + s, at) for k, ids, start, total, s, at in out])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for b in batches:
            keys, losses = b.column(0).to_pylist(), b.column(2).to_pylist()
            for row, ids in enumerate(encoded(b.column(1))):
                loss, total = bool(losses[row]), len(ids)
                whole = capacity if not loss else min(capacity, max_loss)
                at = 0
                if whole == capacity:
                    while total - at >= capacity:
                        out.append((keys[row], ids[at:at + capacity], at, total, packer.sequence, 0))
                        held += capacity
                        packer.sequence += 1
                        at += capacity
                pieces = []
                while at < total:
                    n = min(whole, total - at)
                    pieces.append((keys[row], ids[at:at + n], at, total, loss))
                    at += n
                if pieces:
                    packer.add(pieces)
                while len(packer.items) >= POOL:
                    full = packer.fill()
                    out += full
                    held += sum(len(x[1]) for x in full)
                if held > 1 << 20:
                    yield batch()
                    out, held = [], 0
        while packer.items:
            out += packer.fill()
        if out:
            yield batch()

    packed = rows.mapInArrow(run, "key long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("key", key)
