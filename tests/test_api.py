import pytest

from cinelens.config import ModelParams
from cinelens.functions.text import display_genres
from cinelens.operators import profiling
from cinelens.plans.model import ContentRecommender
from cinelens.sources import read_csv, read_movielens


def test_csv_scan_quotes_and_empty_fields(spark, tmp_path):
    (tmp_path / "movies.csv").write_text(
        'movieId,title,genres\n1,"A ""q"" B, The",Comedy|Drama\n2,Plain,\n', encoding="utf-8")
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,1,4.5,964980868\n", encoding="utf-8")
    (tmp_path / "tags.csv").write_text("userId,movieId,tag,timestamp\n1,1,funny,964980868\n", encoding="utf-8")
    movies = read_csv(spark, str(tmp_path / "movies.csv"), "movies")
    got = {r.movieId: (r.title, r.genres) for r in movies.collect()}
    assert got[1] == ('A "q" B, The', "Comedy|Drama")
    assert got[2] == ("Plain", None)  # empty field reads as null
    m, r, t = read_movielens(spark, str(tmp_path))
    assert dict(r.dtypes) == {"userId": "bigint", "movieId": "bigint", "rating": "double", "timestamp": "bigint"}
    assert t.count() == 1


def test_display_genres_double_space(spark):
    # Q18: the comma rule runs on the pipe rule's output.
    df = spark.createDataFrame([("Comedy|Drama",)], "genres string")
    assert df.select(display_genres("genres").alias("g")).first().g == "Comedy,  Drama"


def test_unfitted_recommender_raises(spark):
    movies = spark.createDataFrame([(1, "A", "x", "", "adventure")],
                                   "movieId long, title string, genres string, tag string, movie_text string")
    rec = ContentRecommender(movies, ModelParams(n_components=None))
    with pytest.raises(RuntimeError):
        rec.recommend(1)
    with pytest.raises(RuntimeError):
        rec.save_model("/nonexistent")
    with pytest.raises(RuntimeError):
        rec.evaluate_leave_one_out(movies)


def test_recommender_facade_roundtrip(spark, tmp_path):
    movies = spark.createDataFrame(
        [(1, "A", "x", "", "adventure animation"), (2, "B", "y", "", "adventure"), (3, "C", "z", "", "crime"),
         (4, "D", "w", "", "comedy romance"), (5, "E", "v", "", "comedy")],
        "movieId long, title string, genres string, tag string, movie_text string")
    ratings = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0), (2, 4, 5.0)], "userId long, movieId long, rating double")
    rec = ContentRecommender(movies, ModelParams(n_components=3)).fit(ratings)
    a = sorted(rec.recommend([1, 2, 7], 2).select("userId", "rank", "movieId").collect())
    path = str(tmp_path / "m")
    rec.save_model(path)
    again = ContentRecommender.load_model(path, movies, ratings)
    assert sorted(again.recommend([1, 2, 7], 2).select("userId", "rank", "movieId").collect()) == a
    assert sorted(r.movieId for r in rec.get_actual_liked_movies(1).collect()) == [1, 2]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (5.0,), (5.0,)], "rating double")
    h = {r.bin: r["count"] for r in profiling.histogram(df, "rating", 3).collect()}
    assert h == {0: 2, 1: 0, 2: 2}


def test_duplicated_rows_and_pairs(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "movieId long, title string")
    assert sorted(r.movieId for r in profiling.duplicated_rows(df, "title").collect()) == [1, 2]
    r = spark.createDataFrame([(1, 1, 4.0), (1, 1, 3.0), (2, 1, 4.0)], "userId long, movieId long, rating double")
    assert [(x.userId, x.movieId, x.duplicates) for x in profiling.duplicate_pairs(r).collect()] == [(1, 1, 2)]


def test_cosine_expression(spark):
    from cinelens.functions.vectors import cosine

    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine("a", "b").alias("c")).collect()]
    assert abs(got[0] - 2 ** -0.5) < 1e-12 and got[1] == 0.0  # zero vector -> 0
