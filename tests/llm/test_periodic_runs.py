import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F
from scoutlab.llm.periodic_runs import collapsed, find_runs, periodic_runs, periodic_tail, runs_of, stable_words
from scoutlab.llm.queries import LLM_QUERIES


def brute(w):
    """Runs (start, length, period) by the definition, every lag compared word by word."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(doc_id, w, runs):
    best = None
    for s, k, q in runs:
        if best is None or k * best[2] > best[1] * q:
            best = (s, k, q)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        w = []
        while len(w) < rng.randrange(5, 260):
            unit = [rng.choice("abcdefgh") + str(rng.randrange(rng.choice((1, 4, 40)))) for _ in range(rng.choice((1, 1, 2, 3, 5, 9, 17, 33)))]
            w += (unit * rng.randrange(1, 9))[:rng.randrange(1, 200)]
        out.append([x.encode() for x in w])
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    given = texts(seed)
    assert runs_of(given) == [brute(w) for w in given]


@pytest.mark.parametrize("letters", ["a", "ab", "abc"])
def test_runs_over_small_alphabets(letters):
    rng = random.Random(len(letters))
    given = [[rng.choice(letters).encode() for _ in range(rng.randrange(0, 150))] for _ in range(40)]
    given += [[x.encode() for x in "a" * 16 + "b" + "a" * 16 + "b" + "a" * 16 + "b" + "a" * 16 + "b" + "a" * 3], [b"a"] * 500, [b"a", b"b"] * 400]
    assert runs_of(given) == [brute(w) for w in given]


def test_words_only_join_runs_where_they_are_frequent():
    # x occurs four times, but never within a segment that can hold a run
    w = "x a1 a2 a3 x a4 a5 a6 x a7 a8 a9 x".split() + "p q r".split() * 4 + "y y y y y y".split()
    numbers = {}
    ids = np.array([numbers.setdefault(x, len(numbers)) for x in w])
    live = stable_words(ids, np.zeros(len(w), np.int64))
    assert live.tolist() == list(range(13, 13 + 12 + 6))


def test_hashes_that_collide_are_decided_by_the_words(monkeypatch):
    import scoutlab.llm.periodic_runs as module
    given = texts(3)
    monkeypatch.setattr(module, "mix", lambda x: x & np.uint64(1))
    assert module.runs_of(given) == [brute(w) for w in given]


def test_long_texts_take_near_linear_time():
    import time
    rng = random.Random(5)
    unit = [b"%d" % rng.randrange(50) for _ in range(20_000)]
    given = [[b"%d" % rng.randrange(50) for _ in range(150_000)], [b"a", b"b", b"b"] * 60_000, unit * 5 + [b"z"]]
    began = time.time()
    found = runs_of(given)
    assert time.time() - began < 20
    assert (0, 180_000, 3) in found[1]
    assert (0, 100_000, 20_000) in found[2]


def test_collapsed_keeps_a_first_period():
    w = b"a b c a b c a b c a b c d".split()
    assert collapsed(w, runs_of([w])[0]) == b"a b c d"


def test_operator_and_planted_tails(spark, docs, rows):
    out = periodic_runs(docs, periodic_tail(F.col("doc_id"), F.col("text"))).collect()
    want = Counter()
    for d, t, _, _ in rows:
        w = planted(d, (t or "").encode().split())
        runs = runs_of([w])[0]
        assert len(w) > 600 or runs == brute(w)
        want[d, len(w), tuple(runs), collapsed(w, runs).decode()] += 1
    got = Counter((r._row.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in out)
    assert got == want and any(len(r.runs) for r in out)


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = Counter()
    for r in docs:
        w = planted(r.doc_id, (r.text or "").encode().split())
        want[digest(r.doc_id, w, brute(w) if len(w) < 1500 else runs_of([w])[0])] += 1
    got = LLM_QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()
    assert Counter(tuple(r)[:8] for r in got) == want


def test_empty(no_docs):
    assert periodic_runs(no_docs).count() == 0
    assert find_runs(np.empty(0, np.int64), 0) == [] and runs_of([]) == [] and runs_of([[]]) == [[]]
