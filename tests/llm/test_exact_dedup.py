import hashlib
from collections import Counter, defaultdict

import numpy as np

from scoutlab.llm.exact_dedup import build_filter, drop_copies, exact_duplicates, merge_filters

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_matches_brute_force(docs, rows):
    groups = defaultdict(list)
    for d, t, _, _ in rows:
        groups[(t or "").translate(LOWER)].append(d)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_duplicates(docs).collect()) == want


def test_drop_copies_leaves_one_row_of_each_text_and_all_columns(docs, rows):
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    got = Counter((r.text or "").translate(LOWER) for r in kept.collect())
    assert got == Counter({(t or "").translate(LOWER) for _, t, _, _ in rows})


def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 500, 2000, dtype=np.uint64) << np.uint64(53) | rng.integers(0, 3, 2000, dtype=np.uint64) for _ in range(5)]
    want = Counter(np.concatenate(parts).tolist())
    got = Counter()
    filters = [build_filter(p, 6) for p in parts]
    for cut in range(64):
        runs = [f[f["cut"] == cut] for f in filters]
        runs = [r.iloc[0] for r in runs if len(r)]
        if runs:
            r, c = merge_filters([x["remainders"] for x in runs], [x["counts"] for x in runs])
            assert (np.diff(r.astype(object)) > 0).all()
            got.update({(cut << 58) | int(a): int(n) for a, n in zip(r, c)})
    assert got == want


def test_empty(no_docs):
    assert exact_duplicates(no_docs).count() == 0 and drop_copies(no_docs).count() == 0
