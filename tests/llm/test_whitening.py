import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF_SMALL
from scoutlab.llm import whitening
from scoutlab.llm.queries import LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n long, _key string, i int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "k", 3) for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors, k=8):
    """Exact covariance by fractions, eigenvectors of it, per usable row."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    cov = [[float(sum(Fraction(r[i] * n - s[i], n) * Fraction(r[j] * n - s[j], n) for r in x) / n) for j in range(d)] for i in range(d)]
    e, q = np.linalg.eigh(np.array(cov))
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    y = np.array([[float(Fraction(r[j] * n - s[j], n)) for j in range(d)] for r in x])
    return n, [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x], y @ q / np.sqrt(e), e / np.trace(cov)


def by_row(df):
    out = defaultdict(list)
    for r in df.orderBy("vec_id", "component").collect():
        out[r.vec_id].append(r)
    return out


def test_matches_exact_fractions(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) * [1, 40, 0.2, 3, 1] + 7
    vectors = [(i, v.astype("float32").tolist()) for i, v in enumerate(base)]
    n, deviation, whitened, explained = brute([v for _, v in vectors])
    odd = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [math.nan] * 5), (103, [math.inf, 0.0, 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0])]
    got = by_row(whitening.whiten(frame(spark, vectors + odd)))
    assert sorted(got) == list(range(60))
    sign = np.sign([got[0][c].whitened * whitened[0, c] for c in range(5)])
    for i, rows in got.items():
        assert [r.component for r in rows] == [1, 2, 3, 4, 5] and {r.n for r in rows} == {n}
        assert {r.deviation for r in rows} == {deviation[i]}
        assert np.allclose([r.whitened for r in rows] * sign, whitened[i], rtol=1e-9, atol=1e-9)
        assert np.allclose([r.explained for r in rows], explained, rtol=1e-9)
        assert rows[0].identity_error < 1e-6


def test_square_sums_are_exact():
    rng = np.random.default_rng(4)
    for top in (1 << 10, 1 << 24, 1 << 40, 1 << 61):
        y = rng.integers(-top, top, (1500, 4))
        total = np.zeros((4, 4), object)
        whitening._squares(y, total)
        z = y.astype(object)
        for i in range(4):
            for j in range(i, 4):
                side = z[:, i] if i == j else z[:, i] + z[:, j]
                assert total[i, j] == (side * side).sum()
                assert whitening.from_limbs(whitening.limbs(int(total[i, j]))) == total[i, j]
    assert whitening.from_limbs(whitening.limbs(-5)) == -5


def test_repeated_rows_null_ids_and_dead_components(spark):
    vectors = [(None, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (2, [3.0, 2.0, 0.5])]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert Counter(r.vec_id for r in rows) == {None: 3, 1: 6, 2: 3}
    assert {r.n for r in rows} == {4} and all((r.whitened is None) == (r.component > 1) for r in rows)
    assert abs(sum(r.whitened for r in rows if r.component == 1)) < 1e-12
    one = whitening.whiten(frame(spark, vectors[:1])).collect()
    assert len(one) == 3 and {r.whitened for r in one} == {None} and {r.identity_error for r in one} == {0.0}


def test_large_entries_stay_whole(spark):
    vectors = [(i, [1e30 * (-1) ** i, float(i)]) for i in range(6)]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert len(rows) == 12 and {r.deviation for r in rows} == {None}


def test_empty(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


@pytest.fixture(scope="module")
def given(spark):
    return {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}


def test_query_on_embeddings(spark, given):
    got = by_row(LLM_QUERIES["op12_whitening"](spark, SF_SMALL))
    keys = sorted(given)
    n, deviation, whitened, explained = brute([given[k] for k in keys])
    assert sorted(got) == keys
    sign = np.sign([got[keys[0]][c].whitened * whitened[0, c] for c in range(8)])
    for i, key in enumerate(keys):
        assert got[key][0].deviation == deviation[i] and got[key][0].n == n
        assert np.allclose([r.whitened for r in got[key]] * sign, whitened[i], rtol=1e-6, atol=1e-7)
    assert np.allclose([r.explained for r in got[keys[0]]], explained, rtol=1e-9) and got[keys[0]][0].identity_error < 1e-4
