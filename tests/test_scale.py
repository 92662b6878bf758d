"""What must hold at any size: positions, skewed joins, budgets, stored parts."""

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cinelens import session
from cinelens.config import ModelParams, TfidfParams
from cinelens.functions import text
from cinelens.operators import factorize, features, prepare, profiling
from cinelens.operators.scoring import grid_size
from cinelens.plans import model as M
from cinelens.session import ensure_checkpoint_dir, release, stored
from cinelens.sources import store
from cinelens.streaming import serve


def test_row_index_of_two_million_rows(spark):
    n = 2_000_000
    movies = spark.range(n).select((F.col("id") * 7 % n).alias("movieId"), F.concat(F.lit("title "), "id").alias("title"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = features.row_index(movies)
        assert got.filter("idx <> movieId").count() == 0 and got.count() == n and got.filter("title is null").count() == 0
        pos = profiling.positions(movies, "movieId")
        assert pos.filter("_pos <> movieId").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_bigrams_are_linear_and_tokenized_once(spark):
    def seconds(words):
        df = spark.range(8).select(F.col("id").alias("movieId"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " ").alias("movie_text")).checkpoint()
        t = time.perf_counter()
        assert features.doc_terms(df).count() == 8 * (2 * words - 1)
        return time.perf_counter() - t

    seconds(500)
    assert seconds(20000) < 8 * max(seconds(2000), 0.5)
    plan = spark.range(1).select(F.lit(1).alias("movieId"), F.lit("a b").alias("movie_text"))
    assert features.doc_terms(plan)._jdf.queryExecution().executedPlan().toString().count("Generate") == 1
    tok = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in tok.select(text.ngrams(F.col("t"), (1, 3))).collect()] == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]
    assert [r[0] for r in tok.select(text.ngrams(F.col("t"), (2, 2))).collect()] == [["a b", "b c"], [], []]


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "8"}


@pytest.mark.parametrize("case", ["last_rating", "duplicated"])
def test_hot_key_is_split(spark, case):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
        rows = spark.range(0, 200_000, 1, 16).select(hot.alias("userId"), F.col("id").alias("movieId"), F.lit(4.0).alias("rating"), F.xxhash64("id").alias("timestamp"))
        out = prepare.mark_last_rating_per_user(rows) if case == "last_rating" else profiling.duplicated_rows(rows, "userId")
        out.write.format("noop").mode("overwrite").save()
        out.count()
        plan = out._jdf.queryExecution()
        plan.executedPlan().execute().count()
        assert "skew=true" in plan.executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_budget_decides_the_grid():
    sizes = [grid_size(10**8, 10**6, 100, mb << 20) for mb in (64, 256, 1024)]
    assert sizes[0][0] > sizes[1][0] >= sizes[2][0] and sizes[0][1] > sizes[1][1] > sizes[2][1]
    assert grid_size(1000, 1000, 10, 1 << 20, n_seen=10**8)[1] > grid_size(1000, 1000, 10, 1 << 20)[1]


def test_svd_keeps_small_directions_and_bounds_width(spark):
    """Singular values from 1 down to 1e-7 all survive."""
    n = 8
    weights = spark.createDataFrame([(i, f"t{i}", 10.0**-i) for i in range(n)], "movieId long, term string, weight double")
    items, basis, sigma = factorize.randomized_svd(weights, weights.select("movieId"), n, oversample=0, power_iters=2)
    assert [round(float(s) * 10**i, 3) for i, s in enumerate(sigma)] == [1.0] * n
    with pytest.raises(ValueError):
        factorize.gram(items, "vec", 4000)


def small_model(spark, **params):
    movies = spark.createDataFrame([(i, f"T{i}", "x", "", t) for i, t in enumerate(["red fox", "red dog", "blue fox", "blue cat", "green cat", "red cat"])],
                                   "movieId long, title string, genres string, tag string, movie_text string")
    ratings = spark.createDataFrame([(1, 0, 5.0), (1, 1, 4.0), (2, 3, 5.0), (3, 4, 2.0)], "userId long, movieId long, rating double")
    return M.fit(movies, ratings, ModelParams(**params)), ratings


def test_store_lists_its_parts(spark, tmp_path):
    svd, ratings = small_model(spark, n_components=2)
    exact, _ = small_model(spark, n_components=None)
    path = str(tmp_path / "model")
    store.save_model(svd, path)
    store.save_model(exact, path)
    loaded = store.load_model(spark, path, exact.movies, ratings)
    assert loaded.term_basis is None and loaded.params.n_components is None
    assert sorted(p.name for p in (tmp_path / "model").iterdir())[0] == "manifest.json" and len(list((tmp_path / "model").iterdir())) == 2
    bare = store.load_model(spark, path, exact.movies)
    assert bare.recommend(spark.createDataFrame([(99,)], "userId long"), 3).count() == 3
    with pytest.raises(RuntimeError):
        bare.recommend(spark.createDataFrame([(1,)], "userId long"), 3)


def test_any_k_is_answered(spark):
    model, _ = small_model(spark, n_components=None)
    req = spark.createDataFrame([("a", 1, 5), ("b", 42, 6), ("c", 2, None), ("d", 2, 0)], serve.REQUEST_SCHEMA)
    got = {r["request_id"]: r["n"] for r in serve.answer_requests(model, req).groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    assert got["a"] >= 4 and got["b"] == 6 and got["c"] >= 5 and "d" not in got


def test_stored_tables(spark):
    ensure_checkpoint_dir(spark)
    df = stored(spark.range(5))
    path = df.stored_path
    assert df.count() == 5 and spark.read.parquet(path).count() == 5
    release(df)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_shuffle_files_of_stored_tables_go(spark):
    ensure_checkpoint_dir(spark)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if f.startswith("shuffle_")}
    before, setting = files(), spark.conf.get(session.SHUFFLE_CLEANUP)
    df = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert not files() - before and df.count() == 7
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == setting
    release(df)


def test_genre_pattern_quotes_names(spark):
    df = spark.createDataFrame([("A.B",), ("AxB",), ("a.b|C(D",)], "genres string")
    bad = profiling.malformed_genres(df, ["A.B", "C(D"]).collect()
    assert [r[0] for r in bad] == ["AxB"]


def test_pruned_vocabulary(spark):
    movies = spark.createDataFrame([(1, "aa bb"), (2, "aa cc"), (3, "aa cc dd")], "movieId long, movie_text string")
    _, vocab = features.tfidf(movies, replace(TfidfParams(), min_df=2, max_df=0.9, ngram_range=(1, 1)))
    assert [r["term"] for r in vocab.collect()] == ["cc"]
