import pytest

from cinelens.operators import validate

M = "movieId long, title string, genres string"
R = "userId long, movieId long, rating double, timestamp long"
T = "userId long, movieId long, tag string, timestamp long"


def _movies(spark, data=None):
    return spark.createDataFrame(data or [(1, "A", "x"), (2, "B", "y"), (3, "C", "z")], M)


def test_movies_null_raises(spark):
    with pytest.raises(ValueError, match="Null movieId found"):
        validate.validate_movies(_movies(spark, [(1, None, "x"), (2, "B", "y")]))


def test_movies_duplicate_ids_raise_titles_warn(spark):
    with pytest.raises(ValueError, match="Duplicate movieId found"):
        validate.validate_movies(_movies(spark, [(1, "A", "x"), (1, "B", "y")]))
    validate.validate_movies(_movies(spark, [(1, "A", "x"), (2, "A", "y")]))  # warning only


def test_ratings_checks(spark):
    movies = _movies(spark)
    ok = spark.createDataFrame([(1, 1, 0.0, 0), (1, 2, 5.0, 0), (2, 3, 3.0, 0), (2, 1, 4.0, 0)], R)
    validate.validate_ratings(ok, movies, 2)
    with pytest.raises(ValueError, match="unknown movieIds"):
        validate.validate_ratings(ok.union(spark.createDataFrame([(1, 99, 4.0, 0)], R)), movies, 2)
    with pytest.raises(ValueError, match="invalid values"):
        validate.validate_ratings(ok.union(spark.createDataFrame([(1, 3, 5.5, 0)], R)), movies, 2)
    with pytest.raises(ValueError, match="more than 2 ratings"):
        validate.validate_ratings(ok.union(spark.createDataFrame([(7, 3, 4.0, 0)], R)), movies, 2)
    with pytest.raises(ValueError, match="Null ratings found"):
        validate.validate_ratings(ok.union(spark.createDataFrame([(1, 3, None, 0)], R)), movies, 2)


def test_empty_ratings_is_a_validation_error(spark):
    with pytest.raises(ValueError, match="invalid values"):  # Q13
        validate.validate_ratings(spark.createDataFrame([], R), _movies(spark), 2)


def test_tags_checks(spark):
    movies = _movies(spark)
    with pytest.raises(ValueError, match="Tags table contains 1 unknown movieIds"):
        validate.validate_tags(spark.createDataFrame([(1, 99, "t", 0), (1, 1, "u", 0)], T), movies)
    with pytest.raises(ValueError, match="Null values found in tags"):
        validate.validate_tags(spark.createDataFrame([(1, 1, None, 0)], T), movies)


def test_report_order(spark):
    movies = _movies(spark)
    ratings = spark.createDataFrame([(1, 1, 4.0, 0), (1, 2, 4.0, 0)], R)
    tags = spark.createDataFrame([(1, 1, "t", 0)], T)
    rep = validate.validation_report(movies, ratings, tags).collect()
    assert [(r.table, r.check) for r in rep][:4] == [
        ("movies", "nulls"), ("movies", "duplicate_ids"), ("movies", "duplicate_titles"), ("ratings", "nulls")]
    assert all(r.n_bad == 0 for r in rep)
