"""Bracketed selection, Gram correlation, encodings, dirty files and the iterative imputer's two paths."""

import gzip
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from scoutlab.operators import impute as I, mlprep as M, profile as G, selection as Q
from scoutlab.sources import io


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 4000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None, "c"], n), "x": rng.normal(size=n) * 10.0 ** rng.integers(-8, 8, n),
                        "y": rng.integers(0, 7, n).astype(float), "z": np.where(rng.random(n) < 0.3, np.nan, rng.normal(1e9, 1e-3, n))})
    rows = [(g, x, y, None if math.isnan(z) else z) for g, x, y, z in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double").repartition(5).cache()
    return pdf, df


@pytest.mark.parametrize("listed,counters", [(1 << 16, 1 << 20), (8, 64)])
def test_quantiles_match_numpy_on_any_budget(frame, monkeypatch, listed, counters):
    pdf, df = frame
    monkeypatch.setattr(Q, "LISTED", listed)
    monkeypatch.setattr(Q, "COUNTERS", counters)
    probs = [0.0, 0.01, 0.5, 0.77, 1.0]
    got = Q.quantiles(df, ["x", "y", "z"], probs)[()]
    for c in "xyz":
        for p in probs:
            assert got[c, p] == pytest.approx(np.nanquantile(pdf[c], p), rel=1e-15, abs=0)
    grouped = Q.quantiles(df, ["x", "z"], [0.25, 0.5], ["g"])
    for g, part in pdf.groupby("g", dropna=False):
        of = grouped[(None if g is None or g != g else g,)]
        assert all(of[c, p] == pytest.approx(np.nanquantile(part[c], p), rel=1e-15) for c in "xz" for p in (0.25, 0.5))


def test_too_many_groups_take_the_sorted_plan(frame, monkeypatch):
    _, df = frame
    want = {(r.g, r.col_name): r.asDict() for r in G.describe(df, ["x", "y"], ["g"]).collect()}
    box = {(r.g, r.col_name): r.asDict() for r in G.boxplot_stats(df, ["x", "y"], ["g"]).collect()}
    monkeypatch.setattr(G, "quantiles", lambda *a, **k: None)
    monkeypatch.setattr(G, "MAX_BRACKETS", 1)
    for got, expected in ((G.describe(df, ["x", "y"], ["g"]), want), (G.boxplot_stats(df, ["x", "y"], ["g"]), box)):
        rows = {(r.g, r.col_name): r.asDict() for r in got.collect()}
        assert rows.keys() == expected.keys()
        for key, row in rows.items():
            assert all(v == (pytest.approx(expected[key][k]) if isinstance(v, float) else expected[key][k]) for k, v in row.items())


def test_selection_edge_values(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in (-0.0, 0.0, -inf, inf, nan, 5e-324, -5e-324, None)], "v double")
    got = Q.quantiles(df, ["v"], [i / 6 for i in range(7)])[()]
    values = [got["v", i / 6] for i in range(7)]
    assert values[:6] == [-inf, -5e-324, 0.0, 0.0, 5e-324, inf] and math.isnan(values[6])
    none = spark.createDataFrame([], "g string, v double")
    assert Q.quantiles(none, ["v"], [0.5])[()] == {("v", 0.5): None} and Q.quantiles(none, ["v"], [0.5], ["g"]) == {}
    assert G.describe(none, ["v"]).count() == 0 and G.iqr_outliers(none, ["v"]).count() == 0


def test_gram_correlation_matches_pandas(frame, spark):
    pdf, df = frame
    df = df.withColumns({"w": F.col("y") * 2 + 1, "k": F.lit(0.1)})
    pdf = pdf.assign(w=pdf.y * 2 + 1, k=0.1)
    cols = ["x", "y", "z", "w", "k"]
    want = pdf.assign(z=pdf.z - 1e9)[cols].corr()  # exact differences: pandas itself loses digits on z
    got = {(r.a, r.b): r.r for r in G.corr_matrix(df, cols).collect()}
    assert len(got) == 25
    for a in cols:
        for b in cols:
            if "k" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(1.0 if a == b else want.loc[a, b], abs=1e-6)
    assert {r.r for r in G.corr_matrix(spark.createDataFrame([], "x double, y double"), ["x", "y"]).collect()} <= {None}


def test_iterative_knn_is_the_same_on_both_paths(spark):
    rng = random.Random(4)
    rows = [(f"k{i:03}", *[None if rng.random() < 0.2 else rng.uniform(0, 10 * (j + 1)) for j in range(3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, a double, b double, c double")
    one, two = ({r.k: (r.a, r.b, r.c) for r in I.impute_iterative_knn(df, "k", ["a", "b", "c"], max_iter=1, donor_bytes=bound).collect()}
                for bound in (1 << 20, 0))
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], rel=1e-12) for k in one)


def test_a_query_whose_own_cells_hold_too_few_donors(spark):
    donors = [(i, float(i), float(i % 3), float(i)) for i in range(1, 8)]
    df = spark.createDataFrame([(0, 7.9, 1.0, None), *donors], "k int, a double, b double, c double")
    assert {r.k: r.c for r in I.impute_knn(df, "k", ["a", "b", "c"], k=6).collect()}[0] == sum(range(2, 8)) / 6


def test_sparse_encoding_of_many_unknown_and_null_categories(spark):
    train = spark.createDataFrame([(f"v{i % 700:04}", None if i % 3 else "é") for i in range(2100)], "a string, b string")
    index = M.category_index(train, ["a", "b"])
    assert [r.value for r in index.filter("col_name = 'a'").orderBy("idx").collect()] == [f"v{i:04}" for i in range(700)]
    df = spark.createDataFrame([(1, 2.5, "v0003", "é"), (2, None, "new", None)], "k int, x double, a string, b string")
    got = {r.k: r.features for r in M.encode(df, ["x"], ["a", "b"], index).collect()}
    assert (got[1].size, got[1].indices, got[1].values) == (1 + 701 + 3, [0, 4, 1 + 701 + 1], [2.5, 1.0, 1.0])
    assert got[2].indices == [0, 701, 702] and math.isnan(got[2]["values"][0])
    with pytest.raises(ValueError):
        M.categories(train, "a", most=699)


def test_catalogue_reports_bad_files_and_goes_on(spark, tmp_path):
    for name, text in (("b.csv.gz", 'id,"last, first",x\n1,2,3\n'), ("a.csv.gz", "only\n")):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(text + "1\n" * 20_000)
    (tmp_path / "broken.csv.gz").write_bytes(b"this is no gzip")
    (tmp_path / "other.txt").write_text("x")
    rows = io.schema_catalog(spark, str(tmp_path)).collect()
    assert [(r.file, r.n_columns, r.position, r.column_name) for r in rows] == [
        ("a.csv.gz", 1, 0, "only"), ("b.csv.gz", 3, 0, "id"), ("b.csv.gz", 3, 1, "last, first"), ("b.csv.gz", 3, 2, "x"),
        ("broken.csv.gz", 0, None, None)]
    assert [r.error for r in rows] == [None] * 4 + ["no header could be read"]


def test_dirty_rows_are_rescued(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,b\n1,2.5\nx,3\n4\n5,6,7\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    rows = [(r.a, r.b, r[io.RESCUED]) for r in io.read_csv_permissive(spark, str(tmp_path / "d.csv"), schema).collect()]
    assert rows == [(1, 2.5, None), (None, 3.0, "x,3"), (4, None, "4"), (5, 6.0, "5,6,7")]


def test_position_files_and_missing_ids(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"id": 1, "fen": "a"}, {"id": 2, "fen": null}]')
    positions = io.read_positions_json(spark, str(tmp_path / "p.json"))
    assert io.fen_lookup(positions, 1).first().fen == "a"
    with pytest.raises(KeyError):
        io.fen_lookup(positions, 3)
    wanted = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long")
    assert {(r.id, r.fen, r.error) for r in io.fen_lookups(positions, wanted).collect()} == {
        (1, "a", None), (2, None, None), (3, None, "position 3 not found"), (None, None, "position null not found")}
    (tmp_path / "lines.json").write_text('{"id": 1, "fen": "a"}\nnot json\n{"id": "x", "fen": "b"}\n')
    rows = io.read_positions_json(spark, str(tmp_path / "lines.json"), multi_line=False).collect()
    assert [r.id for r in rows] == [1, None, None] and rows[1][io.RESCUED] == "not json"


def test_knn_over_many_regions_matches_brute_force(spark, monkeypatch):
    """Regions of a few donors, parts of regions that cannot be cut, and equal keys."""
    import numpy as np

    from scoutlab.operators import knn as N
    monkeypatch.setattr(N, "REGION_ROWS", 12)
    monkeypatch.setattr(N, "REGION_SAMPLE", 4)
    rng = random.Random(6)
    feats = ["a", "b", "c"]
    rows = [(i, *[None if rng.random() < 0.15 else float(rng.randrange(5 * 3 ** j)) for j in range(3)]) for i in range(300)]
    rows += [(300 + i, 2.0, 2.0, 40.0 + i) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double").repartition(3)
    x = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows])
    space = N.Space(feats, sorted(set(N._presence(x).tolist())), [0, 1, 2], x, 1.0)
    assert max(r.size for r in space.regions) > 8 and max(r.parts.max() for r in space.regions) > 1
    sizes = N.dealt_donors(df, "k", spark.sparkContext.broadcast(space), feats).groupBy("region").count().agg(F.max("count")).first()[0]
    assert sizes < 100  # of 450 rows
    got = {r.k: r[1:] for r in I.impute_knn(df, "k", feats).collect()}
    means = np.nanmean(x, axis=0)
    for i, row in enumerate(x):
        for j in np.flatnonzero(np.isnan(row)):
            both = ~np.isnan(x) & ~np.isnan(row)
            ok = np.flatnonzero(~np.isnan(x[:, j]) & both.any(1))
            dist = np.sqrt(3 / both[ok].sum(1) * np.where(both, (x - row) ** 2, 0.0)[ok].sum(1))
            near = ok[np.lexsort((ok, dist))][:5]
            assert got[i][j] == pytest.approx(x[near, j].mean() if len(near) else means[j])


def test_iterative_knn_with_repeated_keys_keeps_the_rows(spark):
    rows = [(i // 2, float(i % 7), float(i), None if i % 6 == 0 else float(2 * i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    part = I.impute_iterative_knn(df.filter("k % 3 > 0"), "k", ["a", "b", "c"], max_iter=1, donor_bytes=0)
    assert part.count() == 40
    found = {(r.k, r.b): r.c for r in I.impute_iterative_knn(df, "k", ["a", "b", "c"], max_iter=1, donor_bytes=0).collect()}
    assert len(found) == 60 and None not in found.values()


def holed(seed, n, share):
    rng = random.Random(seed)
    return [(f"k{i:03}", *[None if rng.random() < share else rng.uniform(0, 10 * (j + 1)) for j in range(3)]) for i in range(n)]


def both_paths(spark, rows, **how):
    df = spark.createDataFrame(rows, "k string, a double, b double, c double")
    return [I.impute_iterative_knn(df, "k", ["a", "b", "c"], donor_bytes=bound, **how) for bound in (1 << 20, 0)]


def test_iterative_knn_over_sweeps_keeps_the_planners_estimate_small(spark):
    """A join of the rows with what was found from them squared the estimated size in every
    visit, until the planner did nothing else."""
    one, two = both_paths(spark, holed(11, 80, 0.2), max_iter=3, tol=0.0)
    assert two._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 5_000
    one, two = ({r.k: (r.a, r.b, r.c) for r in df.collect()} for df in (one, two))
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], rel=1e-12) for k in one)


@pytest.mark.parametrize("share", [0.1, 0.45])
def test_iterative_knn_over_many_regions(spark, monkeypatch, share):
    """Donors in several regions, with and without enough rows that are complete."""
    from scoutlab.operators import knn as N
    monkeypatch.setattr(N, "REGION_ROWS", 12)
    monkeypatch.setattr(N, "REGION_SAMPLE", 4)
    rows = holed(12, 150, share) + ([] if share < 0.2 else [(f"m{i:02}", None, float(i), float(-i)) for i in range(30)])
    one, two = ({r.k: (r.a, r.b, r.c) for r in df.collect()} for df in both_paths(spark, rows, max_iter=2, tol=0.0))
    assert len(two) == len(rows) and all(one[k] == pytest.approx(two[k], rel=1e-12) for k in one)


def test_iterative_knn_of_equal_rows_counts_each_donor_once(spark):
    rows = [(f"k{i:02}", float(i), float(i), float(i)) for i in range(12)] + [("twice", 6.2, 6.2, None)] * 2
    for df in both_paths(spark, rows, max_iter=1):
        assert {r.c for r in df.filter("k = 'twice'").collect()} == {6.0}
