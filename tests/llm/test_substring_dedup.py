import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scoutlab.llm import substring_dedup
from scoutlab.llm.substring_dedup import LENGTH, anchored, cover_keys, substring_duplicates


def brute(texts):
    seen = Counter(t[i:i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(frame, rows):
    want = Counter((d, *x) for (d, _), x in zip(rows, brute([(t or "").encode() for _, t in rows])))
    assert Counter(tuple(r) for r in substring_duplicates(frame).collect()) == want


def test_matches_brute_force(docs, rows):
    check(docs, [(d, t) for d, t, _, _ in rows])


@pytest.mark.parametrize("length", [LENGTH - 1, LENGTH, LENGTH + 1, 2 * LENGTH + 37])
def test_shared_passages_at_every_offset(spark, length):
    rng = random.Random(length)
    letters = "abcdefghijklmnopqrstuvwxyzéü \n"

    def noise(n):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = noise(length)
    shared = shared.encode()[:length].decode(errors="ignore")
    rows = [(i, noise(rng.randrange(300)) + shared + noise(rng.randrange(300))) for i in range(25)]
    rows += [(90, noise(200) + shared[:450] + noise(40) + shared[30:] + noise(7)), (91, shared), (92, "ab" * 600), (93, "a" * 401)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_texts_longer_than_a_chunk_and_hot_anchors(spark, monkeypatch):
    """Cut texts, many buckets and split anchors give the same result."""
    monkeypatch.setattr(substring_dedup, "CHUNK", 900)
    monkeypatch.setattr(substring_dedup, "BUCKET", 500)
    monkeypatch.setattr(substring_dedup, "ANCHOR_PIECES", 3)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(470))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(2500))) + passage + str(i) * 40) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_equal_strings_have_equal_keys():
    rng = np.random.default_rng(2)
    one, two = (rng.integers(0, 256, 3000, dtype=np.uint8) for _ in range(2))
    two[1111:1111 + 800] = one[77:877]
    keys = []
    for data, at in ((one, 77), (two, 1111)):
        starts, counts, anchor, _ = anchored(data, np.array([0]))
        owner = np.repeat(anchor, counts)
        positions = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, counts)])
        assert (positions == np.arange(len(data) - LENGTH + 1)).all()
        some = np.arange(at, at + 401)
        keys.append(cover_keys(data, some, owner[some] - some))
    assert (keys[0][0] == keys[1][0]).all() and (keys[0][1] == keys[1][1]).all()
    assert len(np.unique(keys[0][0])) == 401


def test_empty(no_docs):
    assert substring_duplicates(no_docs).count() == 0


class Step:
    """Stands for the frames around a mapInArrow step and holds its function."""

    def mapInArrow(self, function, schema):
        self.function = self.function if hasattr(self, "function") else function
        return self

    def __getattr__(self, name):
        if name == "function":
            raise AttributeError(name)
        return lambda *args, **kwargs: self


def text_pieces(seed, n):
    """A text and all its pieces, as the steps get them."""
    text = np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8)
    starts, counts, at, names = anchored(text, np.array([0]))
    return text.tobytes().decode(), [
        {"piece": seed << 32 | i, "start": int(s), "m": int(m), "distance": int(d), "anchor": int(a), "weight": 1, "splits": 1}
        for i, (s, m, d, a) in enumerate(zip(starts, counts, at - starts, names.view(np.int64)))]


def most_memory(function, batches):
    tracemalloc.start()
    for _ in function(iter(batches)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 2**20


def test_naming_takes_little_memory():
    """600,000 suffixes in 5,000 overlapping pieces: their text is 3 MB when every piece brings its own."""
    texts, lists = zip(*(text_pieces(seed, 50_000) for seed in range(12)))
    piece = pa.struct([(name, pa.int64()) for name in lists[0][0]])
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(lists, pa.list_(piece))], names=["text", "list"])
    step = Step()
    substring_dedup.repeated_suffixes(step, 4)
    assert most_memory(step.function, [batch]) < 80


def test_removal_takes_little_memory():
    """A text of 8 MB that loses a few bytes needs no numbers for each of its bytes."""
    items = pa.array([[{"start": 5, "m": 3, "ats": None}, {"start": 7_000_002, "m": 8, "ats": None}]],
                     pa.list_(pa.struct([("start", pa.int64()), ("m", pa.int64()), ("ats", pa.list_(pa.binary()))])))
    text = "abcdefgh" * 1_000_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text]), items], names=["k1", "k2", "text", "list"])
    step = Step()
    substring_dedup.removals(step)
    found, = list(step.function(iter([batch])))
    kept = text[:5] + text[5 + 402:7_000_002] + text[7_000_409:]
    assert found.to_pylist() == [{"k1": 1, "k2": 2, "n_removed": 402 + 407, "n_spans": 2, "kept_sha256": hashlib.sha256(kept.encode()).hexdigest()}]
    assert most_memory(step.function, [batch]) < 24
