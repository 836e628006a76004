"""Property checks: split sizes and disjointness, imputers, histograms,
quantiles against pandas, Kruskal-Wallis p-values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoutlab.operators import impute as I
from scoutlab.operators import mlprep as M
from scoutlab.operators import profile as G
from scoutlab.operators import stats as K
from scoutlab.plans import standins as S

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def obs(spark):
    return S.player_obs(spark, SF_SMALL).cache()


def test_split_exact_size_and_disjoint(obs):
    n = obs.count()
    s = M.train_test_split(obs.select("obs_id"), "obs_id").cache()
    assert s.filter("is_test").count() == math.ceil(0.2 * n)
    assert s.count() == n and s.select("obs_id").distinct().count() == n
    again = M.train_test_split(obs.select("obs_id"), "obs_id")
    assert sorted(r.obs_id for r in s.filter("is_test").collect()) == \
        sorted(r.obs_id for r in again.filter("is_test").collect())


def test_group_split_disjoint(obs):
    s = M.group_split(obs.select("obs_id", "player_id"), "player_id")
    sides = s.groupBy("player_id").agg(F.count_distinct("is_test").alias("k"))
    assert sides.filter("k > 1").count() == 0
    n_groups = obs.select("player_id").distinct().count()
    assert s.filter("is_test").select("player_id").distinct().count() == math.ceil(0.2 * n_groups)


def test_quantiles_match_pandas(obs):
    cols = ["edad_al_momento", "valor_mercado_eur_TARGET", "dias_para_fin_contrato"]
    q = {(r.col_name, r.p): r.q for r in G.exact_quantiles(obs, cols, [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).collect()}
    pdf = obs.select(*cols).toPandas()
    for c in cols:
        for p in [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]:
            assert q[(c, p)] == pytest.approx(pdf[c].quantile(p), rel=1e-12, abs=1e-9)


def test_histogram_counts_sum_to_non_null(obs):
    h = G.histogram(obs, "altura_cm", 30).collect()
    assert len(h) == 30
    assert sum(r["count"] for r in h) == obs.filter(F.col("altura_cm").isNotNull()).count()
    counts, _ = np.histogram(obs.select("altura_cm").toPandas()["altura_cm"].dropna(), bins=30)
    assert [r["count"] for r in sorted(h, key=lambda r: r.bin)] == counts.tolist()


def test_imputers_fill_and_keep_observed(obs):
    cols = ["edad_al_momento", "altura_cm", "dias_para_fin_contrato"]
    base = obs.select("obs_id", *cols)
    for out in (I.impute_median(base, cols), I.impute_knn(base, "obs_id", cols, k=5)):
        assert out.count() == base.count()
        assert out.filter(" OR ".join(f"{c} IS NULL" for c in cols)).count() == 0
        j = base.alias("a").join(out.alias("b"), "obs_id")
        for c in cols:
            assert j.filter(F.col(f"a.{c}").isNotNull() & (F.col(f"a.{c}") != F.col(f"b.{c}"))).count() == 0


def _knn_brute(pdf, key, feats, k=5):
    """Reference-style nan-Euclidean KNN imputation in pandas."""
    X = pdf[feats].to_numpy(dtype=float)
    keys = pdf[key].to_numpy()
    out = X.copy()
    nf = len(feats)
    for j, f in enumerate(feats):
        miss = np.where(np.isnan(X[:, j]))[0]
        donors = np.where(~np.isnan(X[:, j]))[0]
        for i in miss:
            both = ~np.isnan(X[donors]) & ~np.isnan(X[i])
            cnt = both.sum(axis=1)
            diff = np.where(both, X[donors] - X[i], 0.0)
            ss = (diff * diff).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.sqrt(nf / cnt * ss)
            ok = cnt > 0
            cand = sorted(zip(d[ok], keys[donors][ok], X[donors][ok, j]))[:k]
            out[i, j] = np.mean([c[2] for c in cand]) if cand else np.nanmean(X[:, j])
    return pd.DataFrame(out, columns=feats).assign(**{key: keys})


def test_knn_matches_brute_force(obs):
    feats = ["edad_al_momento", "altura_cm", "dias_para_fin_contrato", "mes_de_nacimiento"]
    base = obs.select("obs_id", *feats)
    got = I.impute_knn(base, "obs_id", feats).toPandas().sort_values("obs_id").reset_index(drop=True)
    exp = _knn_brute(base.toPandas(), "obs_id", feats).sort_values("obs_id").reset_index(drop=True)
    for f in feats:
        np.testing.assert_allclose(got[f].to_numpy(), exp[f].to_numpy(), rtol=1e-12, atol=1e-9)


def test_iterative_knn_fills(obs):
    feats = ["edad_al_momento", "altura_cm", "dias_para_fin_contrato"]
    base = obs.select("obs_id", *feats)
    out = I.impute_iterative_knn(base, "obs_id", feats, k=5, max_iter=2)
    assert out.count() == base.count()
    assert out.filter(" OR ".join(f"{c} IS NULL" for c in feats)).count() == 0


def test_chi2_sf_known_values():
    # chi-square upper tail: df=1, x=3.841459 -> 0.05 ; df=3, x=7.814728 -> 0.05 ; df=4, x=9.487729 -> 0.05
    assert K.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert K.chi2_sf(7.814728, 3) == pytest.approx(0.05, abs=1e-6)
    assert K.chi2_sf(9.487729, 4) == pytest.approx(0.05, abs=1e-6)
    assert K.chi2_sf(0.0, 3) == pytest.approx(1.0)


def test_kruskal_against_pandas_ranks(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 500).astype(str), "x": rng.integers(0, 30, 500).astype(float)})
    res = K.kruskal_wallis(spark.createDataFrame(pdf), ["x"], "g").collect()[0]
    ranks = pdf["x"].rank()
    n = len(pdf)
    h = 12 / (n * (n + 1)) * sum(ranks[pdf.g == g].sum() ** 2 / (pdf.g == g).sum() for g in pdf.g.unique()) - 3 * (n + 1)
    t = pdf.groupby("x").size()
    h /= 1 - ((t ** 3 - t).sum() / (n ** 3 - n))
    assert res.H == pytest.approx(h, rel=1e-10)
    assert res.k == 4


def test_ranges_and_lists_reach_the_parquet_scan(spark, tmp_path):
    from scoutlab.functions.predicates import PuzzleFilter, ScoutFilter, in_list, in_range
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, "a", 1500, "x")], "v double, l string, Rating int, Themes string").write.parquet(path)
    df = spark.read.parquet(path)

    def pushed(cond):
        plan = df.filter(cond)._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: [")[1].split("]")[0]

    assert "GreaterThanOrEqual(v,0.0)" in pushed(in_range("v", 0, 2)) and "LessThanOrEqual(v,2.0)" in pushed(in_range("v", 0, 2))
    assert "In(l, [a,b" in pushed(in_list("l", ["a", "b"]))
    assert "GreaterThanOrEqual(Rating" in pushed(PuzzleFilter(themes=["x"]).column())
    assert ScoutFilter().column() is not None


def test_text_numbers_fail_a_range_unless_they_are_numbers(spark):
    from scoutlab.functions.predicates import in_range, numeric
    df = spark.createDataFrame([("1",), ("x",), (" 2.5 ",), (None,), ("",), ("9",)], "v string")
    assert [r.v for r in df.filter(in_range("v", 1, 3, text=True)).collect()] == ["1", " 2.5 "]
    assert [r.n for r in df.select(numeric("v").alias("n")).collect()] == [1.0, None, 2.5, None, None, 9.0]


def test_group_split_leaves_rows_without_a_group_out(spark):
    from scoutlab.operators import mlprep as M
    rows = [(i, i % 7 if i % 5 else None) for i in range(60)]
    got = M.group_split(spark.createDataFrame(rows, "k int, g int"), "g").collect()
    assert all((r.is_test is None) == (r.g is None) for r in got)
    assert len({r.g for r in got if r.is_test}) == 2
    assert M.train_test_split(spark.createDataFrame([], "k int"), "k").count() == 0


def brute_iterative(rows, feats, k, sweeps, tol):
    """Plain Python over all pairs; rows: {key: [values]}."""
    keys = sorted(rows)
    seen = {f: [rows[i][f] for i in keys if rows[i][f] is not None] for f in feats}
    cur = {i: [rows[i][f] if rows[i][f] is not None else sum(seen[f]) / len(seen[f]) for f in feats] for i in keys}
    visit = sorted((f for f in feats if len(seen[f]) < len(keys)), key=lambda f: len(keys) - len(seen[f]))
    top = max(abs(v) for f in feats for v in seen[f])
    for _ in range(sweeps):
        prev = {i: list(v) for i, v in cur.items()}
        for f in visit:
            new = {}
            for i in keys:
                if rows[i][f] is None:
                    near = sorted((sum((cur[i][g] - cur[j][g]) ** 2 for g in feats if g != f) ** 0.5, j) for j in keys if rows[j][f] is not None)
                    new[i] = sum(rows[j][f] for _, j in near[:k]) / len(near[:k])
            for i, v in new.items():
                cur[i][f] = v
        if max(sum(abs(a - b) for a, b in zip(cur[i], prev[i])) for i in keys) < tol * top:
            break
    return cur


def test_iterative_knn_matches_brute_force(spark):
    import random

    from scoutlab.operators import impute as I
    rng = random.Random(8)
    # No ties: equal distances could fall either way by the last bit of a sum.
    rows = {i: [None if rng.random() < 0.15 else rng.uniform(0, 10), rng.uniform(0, 12),
                None if rng.random() < 0.2 else rng.uniform(0, 300)] for i in range(60)}
    df = spark.createDataFrame([(i, *v) for i, v in rows.items()], "k int, a double, b double, c double")
    got = {r.k: [r.a, r.b, r.c] for r in I.impute_iterative_knn(df, "k", ["a", "b", "c"], max_iter=2).collect()}
    want = brute_iterative(rows, [0, 1, 2], 5, 2, 1e-3)
    assert all(abs(x - y) < 1e-9 for i in rows for x, y in zip(got[i], want[i]))


def test_knn_candidates_grow_with_the_table(spark):
    """Equal donors are reduced, so pairs per query do not grow."""
    from scoutlab.operators import impute as I
    rows = [(i, float(i % 5), float(i % 3), None if i % 10 == 0 else float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    got = {r.k: r.c for r in I.impute_knn(df, "k", ["a", "b", "c"]).collect()}
    for i in (0, 10, 1990):
        near = [j for j in range(2000) if j % 10 and j % 5 == i % 5 and j % 3 == i % 3][:5]
        assert got[i] == pytest.approx(sum(near) / 5)
