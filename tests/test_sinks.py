"""Sorted sinks, checked CSV scans, and sparse models over wide vocabularies."""

import numpy as np
from pyspark.sql import functions as F

from cinelens.config import ModelParams
from cinelens.functions.vectors import entries
from cinelens.operators import factorize, recommend
from cinelens.operators.profiles import weighted_profiles
from cinelens.plans import model as M
from cinelens.sources.store import buckets_read
from cinelens.sources.sorted import out_of_order, read_in_order, write_sorted
from cinelens.sources.tables import read_checked, read_csv


def test_sorted_folder(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.createDataFrame([((i * 37) % 101, f"x{i}") for i in range(300)] + [(None, "none")], "k long, v string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    try:
        write_sorted(df, path, "k", "v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = read_in_order(spark, path).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(301))
    assert [(r["k"], r["v"]) for r in got] == sorted(((r["k"], r["v"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    check = out_of_order(spark, path, "k", "v").first()
    assert check["rows"] == 301 and check["files"] > 1 and check["inside"] == check["borders"] == 0


def test_disorder_is_seen(spark, tmp_path):
    path = str(tmp_path / "mixed")
    spark.range(100).select(((F.col("id") * 7) % 10).alias("k")).repartition(4).write.parquet(path)
    check = out_of_order(spark, path, "k").first()
    assert check["inside"] > 0 and check["borders"] > 0
    empty = str(tmp_path / "empty")
    write_sorted(spark.range(0).toDF("k"), empty, "k")
    assert read_in_order(spark, empty).count() == 0 and out_of_order(spark, empty, "k").first()["rows"] == 0


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    good = ["1,2,3.5,100", '"4",5,"4.0",200', "6,7,,300"]
    bad = ["1,2,3.5", "1,2,3.5,100,9", "x,2,3.5,100", "1,2,3.5,yesterday", '1,"2,3.5,100', "words"]
    path.write_text("userId,movieId,rating,timestamp\n" + "\n".join(good[:2] + bad + good[2:]) + "\n")
    rows, broken = read_checked(spark, str(path), "ratings")
    assert sorted(map(tuple, rows.collect())) == [(1, 2, 3.5, 100), (4, 5, 4.0, 200), (6, 7, None, 300)]
    assert sorted(r["line"] for r in broken.collect()) == sorted(bad)
    whole = tmp_path / "whole.csv"
    whole.write_text("userId,movieId,rating,timestamp\n" + "\n".join(good) + "\n")
    rows, broken = read_checked(spark, str(whole), "ratings")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, read_csv(spark, str(whole), "ratings").collect())) and broken.count() == 0


def sparse_frame(spark, table, key):
    rows = [(i, (np.flatnonzero(x).tolist(), x[np.flatnonzero(x)].tolist())) for i, x in table.items()]
    return spark.createDataFrame(rows, f"{key} long, vec struct<idx:array<bigint>,val:array<double>>")


def test_sparse_profiles(spark):
    """Weighted means, plain means where the weights cancel, zero profiles."""
    vecs = {1: np.array([0.6, 0, 0.8]), 2: np.array([0, 1.0, 0]), 3: np.zeros(3)}
    items = sparse_frame(spark, vecs, "movieId")
    seen = [(1, 1, 4.0, 1), (1, 2, 2.0, 1), (2, 1, 1.0, 1), (2, 2, -1.0, 3), (3, 3, 5.0, 1), (4, 1, 0.0, 2)]
    rows = spark.createDataFrame(seen, "userId long, movieId long, w double, n double".replace("n double", "n long")).join(items, "movieId")
    got = {}
    for r in weighted_profiles(rows, "w", "n").collect():
        got[r["userId"]] = np.zeros(3)
        got[r["userId"]][r["vec"]["idx"]] = r["vec"]["val"]
    assert np.allclose(got[1], (4 * vecs[1] + 2 * vecs[2]) / 6)
    assert np.allclose(got[2], (vecs[1] + 3 * vecs[2]) / 4)
    assert np.allclose(got[3], 0) and np.allclose(got[4], vecs[1])


def test_popular_sparse_equals_dense(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vecs = {i: rng.random(6) * (rng.random(6) < 0.5) for i in range(40)}
    vecs[7] = np.zeros(6)
    dense = spark.createDataFrame([(i, x.tolist()) for i, x in vecs.items()], "movieId long, vec array<double>")
    want = [(r["movieId"], r["pop_rank"], r["cat_rank"], round(r["similarity"], 9)) for r in recommend.popular(dense, 15, 6).collect()]
    for limit in (100_000, 3):
        monkeypatch.setattr(recommend, "WINDOW_ROWS", limit)
        got = recommend.popular(sparse_frame(spark, vecs, "movieId"), 15, 6).collect()
        assert sorted((r["movieId"], r["pop_rank"], r["cat_rank"], round(r["similarity"], 9)) for r in got) == sorted(want)


def test_exact_model_over_a_wide_vocabulary(spark):
    """More terms than a dense row would bear; lists equal brute force."""
    rng = np.random.default_rng(6)
    texts = {i: " ".join(f"w{j}" for j in rng.integers(0, 30_000, 1500)) for i in range(30)}
    texts[4] = texts[9]
    movies = spark.createDataFrame([(i, f"T{i}", "x", "", t) for i, t in texts.items()] + [(99, "none", "x", "", "")], "movieId long, title string, genres string, tag string, movie_text string")
    liked = [(u, int(i), float(rng.integers(4, 6))) for u in range(8) for i in rng.choice(30, 4, replace=False)]
    ratings = spark.createDataFrame(liked, "userId long, movieId long, rating double")
    m = M.fit(movies, ratings, ModelParams(n_components=None))
    assert m.dims > 40_000
    v = {r["movieId"]: {e["idx"]: e["val"] for e in r["e"]} for r in m.items.select("movieId", entries("vec").alias("e")).collect()}
    assert v[99] == {}
    got = {}
    for r in m.recommend(ratings.select("userId"), 6).collect():
        got.setdefault(r["userId"], []).append((r["rank"], r["movieId"]))
    dot = lambda a, b: sum(x * b.get(t, 0.0) for t, x in a.items())
    for u in range(8):
        p, total = {}, 0.0
        for _, i, w in (x for x in liked if x[0] == u):
            total += w
            for t, x in v[i].items():
                p[t] = p.get(t, 0.0) + w * x
        length = dot(p, p) ** 0.5
        best = sorted((-round(dot(p, x) / length, 9), i) for i, x in v.items() if i not in {i for k, i, _ in liked if k == u})[:6]
        assert [i for _, i in sorted(got[u])] == [i for _, i in best]


def test_short_lists_from_counts(spark):
    items = spark.range(6).toDF("movieId")
    users = spark.createDataFrame([(u,) for u in (1, 2, 3)], "userId long")
    seen = spark.createDataFrame([(1, i % 6) for i in range(9)] + [(2, 0), (2, 0), (2, 77), (9, 1)], "userId long, movieId long")
    for n, want in ((1, {1: 0}), (5, {1: 0}), (6, {1: 0, 2: 5}), (9, {1: 0, 2: 5, 3: 6})):
        assert {r["userId"]: r["L"] for r in recommend.short_lists(users, items, seen, n, 6).collect()} == want


def test_triangle_keeps_small_directions(spark):
    """Singular values down to 1e-12 come out of the tree of factorizations."""
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(200, 5)))
    sizes = np.array([1.0, 1e-3, 1e-6, 1e-9, 1e-12])
    x = (q * sizes) @ np.linalg.qr(rng.normal(size=(5, 5)))[0]
    for parts in (1, 7, 40):
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "movieId long, vec array<double>").repartition(parts).checkpoint()
        r = factorize.triangle(df, "vec", 5)
        assert np.allclose(np.linalg.svd(r, compute_uv=False) / sizes, 1, rtol=1e-3)
        y, width = factorize._orthonormalize(df, "movieId", 5)
        got = np.array([v["vec"] for v in y.collect()])
        assert width == 5 and np.allclose(got.T @ got, np.eye(5), atol=1e-12)
    assert factorize.triangle(df.limit(0).checkpoint(), "vec", 5).shape[0] == 0


def test_store_by_user(spark, tmp_path):
    movies = spark.createDataFrame([(i, f"T{i}", "x", "", t) for i, t in enumerate(["red fox", "red dog", "blue fox", "blue cat", "green cat", "red cat"])],
                                   "movieId long, title string, genres string, tag string, movie_text string")
    ratings = spark.createDataFrame([(u, (u + k) % 6, 5.0 - k) for u in range(40) for k in (0, 1)], "userId long, movieId long, rating double")
    model = M.fit(movies, ratings, ModelParams(n_components=None))
    path = str(tmp_path / "model")
    for buckets in (4, None):
        rec = M.ContentRecommender(movies)
        rec.model = model
        rec.save_model(path, user_buckets=buckets)
        loaded = M.ContentRecommender.load_model(path, movies, None if buckets else ratings)
        for user in (0, 17, 99):
            want = sorted(map(tuple, model.recommend(spark.createDataFrame([(user,)], "userId long"), 4).collect()))
            assert sorted(map(tuple, loaded.recommend(user, 4).collect())) == want
        if buckets:
            for df in loaded.model.lookup(17):
                assert buckets_read(df) == [(1, 4)]
            assert loaded.model.profiles.count() == 40 and loaded.model.seen.count() == 80


def test_report_on_write(spark, tmp_path):
    from cinelens.operators import validate

    movies = spark.createDataFrame([(1, "A", "x"), (1, "A", None), (2, "B", "y")], "movieId long, title string, genres string")
    ratings = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 9.0, None), (2, 7, 3.0, 4)], "userId long, movieId long, rating double, timestamp long")
    tags = spark.createDataFrame([(1, 1, "t", 1), (1, 8, None, 1)], "userId long, movieId long, tag string, timestamp long")
    for k, (m, r, t) in enumerate([(movies, ratings, tags), (movies, ratings.limit(0), tags)]):
        got = validate.report_on_write(m, r, t, str(tmp_path / f"raw{k}"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, validate.validation_report(m, r, t).collect()))
        assert spark.read.parquet(str(tmp_path / f"raw{k}" / "tags")).count() == 2
