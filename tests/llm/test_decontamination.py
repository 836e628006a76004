import hashlib
import random
import re
from collections import Counter

import pytest

from conftest import SF_SMALL
from scoutlab.llm import decontamination
from scoutlab.llm.decontamination import Reader, build, decontaminated, leaks, words_of
from scoutlab.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """(n_words, hit word numbers, item ids) by trying every window at every place."""
    w, hit, ids = words(text), set(), set()
    places = {}
    for item, t in items:
        v = words(t)
        for i in range(max(1, len(v) - window + 1)) if v else ():
            places.setdefault(tuple(v[i:i + window]), set()).add(item)
    for n in {len(p) for p in places}:
        for i in range(len(w) - n + 1):
            found = places.get(tuple(w[i:i + n]))
            if found:
                hit.update(range(i, i + n))
                ids |= found
    return len(w), hit, {str(i) for i in ids if i is not None}


def case(seed, letters=6, window=10):
    rng = random.Random(seed)
    def text(n):
        return " ".join(rng.choice("abcdefghijklmnop"[:letters]) + rng.choice(("", "", ".")) for _ in range(n))
    items = [(i, text(rng.randrange(0, 40))) for i in range(20)] + [(3, text(30)), (None, text(25)), (40, None), (41, "!?"), (5, text(2))]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            parts += [" ".join(w[a:a + rng.randrange(1, 30)]).upper(), text(rng.randrange(0, 20))]
        docs.append((i, " ".join(parts)))
    return docs + [(60, None), (61, ""), (62, "?! -"), (5, docs[5][1]), (None, docs[7][1])], items


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, spans string, n_words int").repartition(3),
            spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, words string"))


def digest(doc_id, text, items, window=10):
    n, hit, ids = brute(text, items, window)
    return doc_id, n, len(hit), tuple(sorted(ids))


@pytest.mark.parametrize("letters,window", [(3, 4), (6, 10), (16, 3), (16, 10)])
def test_matches_every_window_at_every_place(spark, letters, window):
    docs, items = case(letters * window, letters)
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in leaks(*frames(spark, docs, items), window).collect())
    assert got == Counter(digest(d, t, items, window) for d, t in docs)


def test_several_blocks_passes_and_cut_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontamination, "PART_WORDS", 8)
    monkeypatch.setattr(decontamination, "PASS_BLOCKS", 2)
    docs, items = case(9, 12)
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in leaks(*frames(spark, docs, items), 4).collect())
    assert got == Counter(digest(d, t, items, 4) for d, t in docs)


def test_longest_matching_lengths():
    items = [("a", b"t h e c a t s a t".split()), ("b", b"a d o g s a t".split())]
    reader = Reader(build(items, 3))
    text = b"x c a t s a t q d o g s a t".split()
    import numpy as np
    ids = np.array([reader.words.get(w, -1) for w in text])
    got = {z: n for _, z, n, _ in reader.matches(ids)}
    def longest(end):
        return max((k for k in range(end + 1) for _, w in items for i in range(len(w) - k + 1) if w[i:i + k] == text[end - k:end]), default=0)
    assert got == {z: longest(z) for z in range(1, len(text) + 1) if longest(z) >= 3}


def test_spans_are_cut_and_full_documents_go(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    items = [(1, passage)]
    own = " ".join(f"o{i}" for i in range(100))
    docs = [(1, f"{own}, {passage.upper()}! And {own}"), (2, own), (3, passage + " tail"), (4, None), (5, f"{passage} {own}")]
    docs_df, bench = frames(spark, docs, items)
    out = decontaminated(docs_df, bench)
    assert out.columns == docs_df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: f"{own}, ! And {own}", 2: own, 4: None, 5: f" {own}"}
    whole = decontaminated(docs_df, bench, longest_span=12, coverage_permille=1000)
    assert {r.doc_id: r.text for r in whole.collect()} == dict(docs)
    span = leaks(docs_df, bench).filter("doc_id = 1").first()["spans"]
    assert [tuple(s) for s in span] == [(100, 12, 12)]


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {(r.n_hit, tuple(r["items"])) for r in leaks(docs, none).collect()} == {(0, ())}
    assert leaks(no_docs, none).count() == 0
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert leaks(no_docs, some).count() == 0 and decontaminated(no_docs, some).count() == 0


def test_edge_rows(spark, docs, rows):
    items = [(1, rows[0][1]), (2, "one two three"), (3, "ünïcode"), (4, "ü"), (5, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in leaks(docs, bench).collect())
    assert got == Counter(digest(d, t, items) for d, t, _, _ in rows)


def test_query_on_documents(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = Counter()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        d, n, hit, ids = digest(r.doc_id, r.text, items)
        want[d, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0] += 1
    got = LLM_QUERIES["op13_decontamination"](spark, SF_SMALL).collect()
    assert Counter(tuple(r) for r in got) == want and any(r.contaminated for r in got)


def test_words_are_those_of_the_contract():
    text = "It's 3.5 Ünï-cøde\x7fA_b cİD~\x00z"
    assert [w.decode() for w in words_of(text.encode())] == words(text)
