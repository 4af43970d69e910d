
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from audience_engine.operators import (
    assign_clusters,
    build_activity,
    centres_frame,
    choose_k,
    factor_vectors,
    fit_kmeans,
    fit_taste_factors,
    index_ids,
    silhouette,
    standardise,
    wssse,
)
from audience_engine.sources import inputs_from_tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def activity(spark):
    return build_activity(inputs_from_tables(spark, SF_SMALL).plays).activity


def test_sort_indexer_equals_stringindexer(spark):
    from pyspark.ml.feature import StringIndexer
    plays = inputs_from_tables(spark, SF_SMALL).plays
    for col, out in (("UserId", "UserIndex"), ("SongId", "SongIndex")):
        a = {r[0]: r[1] for r in index_ids(plays, col, out).collect()}
        model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc").fit(plays)
        b = {r[0]: int(r[1]) for r in model.transform(plays.select(col).distinct()).select(col, out).collect()}
        assert a == b
        assert sorted(a.values()) == list(range(len(a)))


def test_als_user_factors_solve_normal_equations(spark, activity):
    model = fit_taste_factors(activity, seed=1)
    X = {r.id: np.array(r.features, dtype=float) for r in model.userFactors.collect()}
    Y = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    YtY = sum(np.outer(y, y) for y in Y.values())
    by_user = {}
    for r in activity.select("UserIndex", "SongIndex", "hits").collect():
        by_user.setdefault(r.UserIndex, []).append((r.SongIndex, r.hits))
    worst = 0.0
    for u, items in by_user.items():
        A = YtY + 0.01 * len(items) * np.eye(4)
        b = np.zeros(4)
        for i, h in items:
            y = Y[i]
            A += h * np.outer(y, y)  # alpha 1: confidence - 1 = hits
            b += (1 + h) * y
        x = np.linalg.solve(A, b)
        worst = max(worst, np.max(np.abs(x - X[u])) / max(np.max(np.abs(x)), 1e-9))
    assert worst < 1e-3


def test_als_is_repeatable_with_a_seed(spark, activity):
    a = {r.id: list(r.features) for r in fit_taste_factors(activity, seed=7).userFactors.collect()}
    b = {r.id: list(r.features) for r in fit_taste_factors(activity, seed=7).userFactors.collect()}
    assert a == b


def test_vectors_take_the_whole_array(spark):
    f = spark.createDataFrame([(3, [1.0, 2.0]), (4, [5.0, 6.0])], "id int, features array<float>")
    for with_id, want in ((True, [[3.0, 1.0, 2.0], [4.0, 5.0, 6.0]]), (False, [[1.0, 2.0], [5.0, 6.0]])):
        got = factor_vectors(f, include_id=with_id).select("id", vector_to_array("features").alias("a")).orderBy("id").collect()
        assert [r.a for r in got] == want


def test_vectors_include_id_first(spark):
    f = spark.createDataFrame([(3, [1.0, 2.0, 3.0, 4.0])], "id int, features array<float>")
    v = factor_vectors(f).select(vector_to_array("features").alias("a")).first().a
    assert v == [3.0, 1.0, 2.0, 3.0, 4.0]
    v2 = factor_vectors(f, include_id=False).select(vector_to_array("features").alias("a")).first().a
    assert v2 == [1.0, 2.0, 3.0, 4.0]


def test_standardise_is_mean_and_sample_sd(spark):
    rows = [(i, [float(i), float(i * i), 1.0 + i % 3, -float(i)]) for i in range(1, 30)]
    f = spark.createDataFrame(rows, "id int, features array<float>")
    out = {r.id: r.a for r in standardise(factor_vectors(f))
           .select("id", vector_to_array("features").alias("a")).collect()}
    M = np.array([[float(i)] + list(map(float, x)) for i, x in rows])
    Z = (M - M.mean(axis=0)) / M.std(axis=0, ddof=1)
    for k, (i, _) in enumerate(rows):
        assert np.allclose(out[i], Z[k], atol=1e-9)


@pytest.fixture(scope="module")
def embedded(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    return emb.select(F.col("vec_id").alias("id"), array_to_vector("embedding").alias("features"),
                      F.col("label").alias("cluster"))


def test_kmeans_nearest_centre_and_cost(spark, embedded):
    pts = embedded.select("id", "features")
    model = fit_kmeans(pts, k=5, seed=1)
    assigned = assign_clusters(model, pts)
    centres = np.array(model.clusterCenters())
    data = [(np.array(r.features.toArray()), r.cluster) for r in assigned.collect()]
    for x, c in data:
        d = ((centres - x) ** 2).sum(axis=1)
        assert d[c] <= d.min() + 1e-9
    recomputed = wssse(assigned, centres_frame(spark, model)).first().wssse
    assert recomputed == pytest.approx(model.summary.trainingCost, rel=1e-9)
    again = fit_kmeans(pts, k=5, seed=1)
    assert np.allclose(np.array(again.clusterCenters()), centres)


def test_k_above_point_count(spark):
    pts = spark.createDataFrame([(i, [float(i), float(i % 2)]) for i in range(6)], "id int, a array<double>") \
        .select("id", array_to_vector("a").alias("features"))
    model = fit_kmeans(pts, k=275, seed=1)
    assert len(model.clusterCenters()) <= 6
    assert assign_clusters(model, pts).count() == 6


def test_silhouette_matches_brute_force(spark, embedded):
    data = [(np.array(r.features.toArray()), r.cluster) for r in embedded.collect()]
    X = np.stack([d[0] for d in data])
    y = np.array([d[1] for d in data])
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2)
    s = []
    for i in range(len(X)):
        own = y == y[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, y == c].mean() for c in set(y) if c != y[i])
        s.append(1 - a / b if a < b else (b / a - 1 if a > b else 0.0))
    assert silhouette(embedded) == pytest.approx(float(np.mean(s)), abs=1e-9)


def test_choose_k_rule():
    rows = [(250, 0.30, 100.0), (254, 0.33, 95.0), (258, 0.34, 90.0), (262, 0.40, 85.0), (266, 0.41, 99.0)]
    scored, k = choose_k(rows)
    # changes: 0, 0.1, 0.0303, 0.1765, 0.025
    assert [r[4] for r in scored] == [True, True, False, True, False]
    assert k == 262
    scored0, k0 = choose_k([(10, 0.0, 5.0), (11, 0.2, 4.0)])
    assert scored0[1][3] is None and not scored0[1][4] and k0 == 10  # undefined, told apart from no change
    assert [r[3] for r in choose_k([(1, None, 9.0), (2, 0.5, 8.0), (3, 0.5, 7.0)])[0]] == [0.0, None, 0.0]


def test_select_k_runs_the_sweep(spark, embedded):
    from audience_engine.operators import select_k
    choice = select_k(embedded.select("id", "features"), [2, 3, 4], seed=1)
    rows = choice.metrics.orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4]
    assert rows[0].chosen and rows[0].silhouette_change == 0.0
    assert choice.k in (2, 3, 4)


def test_single_centre_has_no_silhouette(spark):
    from audience_engine.operators import model_silhouette
    pts = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(5)], "id int, a array<double>") \
        .select("id", array_to_vector("a").alias("features"))
    model = fit_kmeans(pts, k=3, seed=1)
    assert len(model.clusterCenters()) == 1
    assert model_silhouette(model, pts) is None


def test_vectorize_columns_takes_every_column_in_order(spark):
    from audience_engine.operators import vectorize_columns
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    out = vectorize_columns(df).select(vector_to_array("features").alias("v")).first().v
    assert out == [1.0, 2.0, 3.0]
    out2 = vectorize_columns(df, exclude=("id",)).select(vector_to_array("features").alias("v")).first().v
    assert out2 == [2.0, 3.0]


def test_cluster_users_renames_columns(spark, embedded):
    from audience_engine.operators import cluster_users
    model, uc = cluster_users(embedded.select("id", "features"), k=3, seed=1)
    assert uc.columns == ["UserIndex", "features", "cluster"]
    assert dict(uc.dtypes)["cluster"] == "int"
    assert uc.select("cluster").distinct().count() <= 3


def test_a_sweep_fits_side_by_side(spark, embedded, monkeypatch):
    """Fits of a sweep overlap, and each is the one that runs alone."""
    import threading

    from audience_engine.operators import clustering
    points = embedded.select("id", "features")
    running, most, lock, fit = [0], [0], threading.Lock(), clustering.fit_kmeans

    def watched(*a, **b):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return fit(*a, **b)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(clustering, "fit_kmeans", watched)
    beside = clustering.select_k(points, [2, 3, 4, 5], seed=1).metrics.orderBy("k").collect()
    assert 1 < most[0] <= clustering.FITS_AT_ONCE
    monkeypatch.setattr(clustering, "FITS_AT_ONCE", 1)
    alone = clustering.select_k(points, [2, 3, 4, 5], seed=1).metrics.orderBy("k").collect()
    for a, b in zip(beside, alone, strict=True):
        assert (a.k, a.chosen) == (b.k, b.chosen)
        assert (a.silhouette, a.wssse) == pytest.approx((b.silhouette, b.wssse), rel=1e-9)


def test_the_pairs_are_read_once_for_the_songs(spark, monkeypatch):
    """Index and salts of the songs come from one count of the pairs, with nulls and repeated rows."""
    from audience_engine.operators import activity as module
    from audience_engine.operators.joins import salt_table
    names, cut = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df, name: (names.append(name), cut(df, name))[1])
    plays = spark.createDataFrame([(f"u{i % 40}", f"s{i * i % 7}") for i in range(300)] * 2 + [("u1", None), (None, "s1")], "UserId string, SongId string")
    built = build_activity(plays, song_buckets=2, rows_per_task=10)
    assert "song-counts" in names
    want = salt_table(plays.groupBy("UserId", "SongId").count(), ["SongId"], 10)
    assert sorted(map(tuple, built.song_salts.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sorted(map(tuple, built.songs.collect()), key=str) == sorted(map(tuple, index_ids(plays, "SongId", "SongIndex").collect()), key=str)
