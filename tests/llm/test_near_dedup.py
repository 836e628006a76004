import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from scoutlab.llm.components import components
from scoutlab.llm.near_dedup import T, drop_near_copies, fast_similarity_sketch, near_duplicates
from scoutlab.llm.shingles import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(w, w[1:], w[2:], w[3:])) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """[(doc_id, set size, smallest doc_id of the component)] over all pairs."""
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    part[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i)), d == least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_matches_all_pairs(docs, rows):
    want = brute([(d, t) for d, t, _, _ in rows])
    assert Counter(tuple(r) for r in near_duplicates(docs).collect()) == want


def test_matches_all_pairs_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert Counter(tuple(r) for r in near_duplicates(docs).collect()) == want


def family(n, keep, seed):
    """Variants of one text, each with its own words changed: linked with the
    original, mostly not with each other."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(200)]
    out = [base]
    for k in range(n - 1):
        out.append([w if rng.random() < keep else f"x{k}_{i}" for i, w in enumerate(base)])
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("keep", [0.96, 0.975, 0.99])
def test_families_around_an_original(spark, keep):
    texts = [(i * 7 % 61, t) for i, t in enumerate(family(60, keep, 5))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert Counter(tuple(r) for r in near_duplicates(docs).collect()) == brute(texts)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    sets = [mix(np.arange(1, n + 1, dtype=np.uint64)) for n in (1, 2, 5, 300, 3000)]
    full = fast_similarity_sketch(sets + [np.empty(0, np.uint64)])
    assert (full[:5] != np.uint64(2**64 - 1)).all() and (full[5] == np.uint64(2**64 - 1)).all()
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200, dtype=np.uint64)])
    one, two = fast_similarity_sketch([np.unique(a), np.unique(b)])
    assert abs((one == two).mean() - 800 / 1200) < 4 * (0.25 / T) ** 0.5


def test_drop_near_copies_keeps_one_of_each_component(docs, rows):
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    want = Counter(d for d, _, _, k in brute([(d, t) for d, t, _, _ in rows]).elements() if k and d is not None)
    assert Counter(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (500, 499)]
    got = {r.node: r.part for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {499: 499, 500: 499}


def test_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0 and drop_near_copies(no_docs).count() == 0


def test_a_kept_row_stays_where_its_id_has_a_near_copy_too(spark):
    a = " ".join(f"a{i}" for i in range(200))
    near, b = a.replace("a100", "changed"), " ".join(f"b{i}" for i in range(50))
    rows = [(3, near), (5, a), (5, b), (5, a), (5, None), (6, a), (7, b), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in drop_near_copies(docs).collect())
    assert kept == Counter([(3, near), (5, b), (5, None), (None, a)])
