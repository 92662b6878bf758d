"""Validation V1-V8: row-set checks that raise ``ValueError``.

Each check is a one-row aggregate; :func:`validation_report` unions them
into ``(table, check, n_bad, fatal, message)`` (V8) and the ``validate_*``
functions raise the first fatal failure in the reference's order. The
report is the only thing collected, a handful of rows.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cinelens.config import MAX_RATING, MIN_RATING, MIN_RATINGS_PER_USER
from cinelens.operators.joins import ID_ROW_BYTES, ID_SET_LIMIT_BYTES, broadcast_if_small

log = logging.getLogger(__name__)

# Fixed messages (equal to the reference's error texts).
MSG_NULL_MOVIES = "Validation failed: Null movieId found"
MSG_DUP_IDS = "Validation failed: Duplicate movieId found"
MSG_NULL_RATINGS = "Validation failed: Null ratings found"
MSG_RATING_ORPHANS = "Validation failed: Ratings dataset contains unknown movieIds"
MSG_RANGE = "Validation failed: Rating column contains invalid values"
MSG_ACTIVITY = "Validation failed: Not every user has more than {n} ratings."
MSG_NULL_TAGS = "Validation failed: Null values found in tags"
MSG_TAG_ORPHANS = "Validation failed: Tags table contains {n} unknown movieIds"


def null_count(df: DataFrame) -> DataFrame:
    """V1: one row ``(n_nulls)``: nulls summed over every column."""
    per_col = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = reduce(lambda a, b: a + b, per_col) if per_col else F.lit(0)
    return df.agg(total.cast("bigint").alias("n_nulls"))


def null_counts_by_column(df: DataFrame, table: str) -> DataFrame:
    """``(table, column, n_nulls)``, one row per column (one scan)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return row.selectExpr(f"stack({len(df.columns)}, {pairs}) as (column, n_nulls)").select(
        F.lit(table).alias("table"), "column", F.col("n_nulls").cast("bigint").alias("n_nulls")
    )


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """V2 / V3: ``rows - distinct values`` of one column, as ``n_dup``."""
    return df.agg((F.count(F.lit(1)) - F.countDistinct(column)).alias("n_dup"))


def orphan_count(df: DataFrame, movies: DataFrame) -> DataFrame:
    """V4 / V7 (J5, J6): rows whose movieId is not in ``movies``.

    The catalogue ids are counted and broadcast into the anti join when
    they fit, so the ratings table is not shuffled just to be checked."""
    ids = movies.select("movieId")
    ids = broadcast_if_small(ids, ids.count(), ID_ROW_BYTES, ID_SET_LIMIT_BYTES)
    orphans = df.select("movieId").join(ids, "movieId", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("n_orphans"))


def rating_range(ratings: DataFrame, lo: float = MIN_RATING, hi: float = MAX_RATING) -> DataFrame:
    """V5 (A14): ``(min_rating, max_rating, out_of_range)``; bounds inclusive."""
    return ratings.agg(F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating")).select(
        "min_rating",
        "max_rating",
        ((F.col("min_rating") < F.lit(lo)) | (F.col("max_rating") > F.lit(hi))).alias("out_of_range"),
    )


def low_activity_users(ratings: DataFrame, floor: int = MIN_RATINGS_PER_USER) -> DataFrame:
    """V6: number of users with fewer than ``floor`` ratings, ``n_low``."""
    per_user = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
    return per_user.agg(F.count_if(F.col("n") < F.lit(int(floor))).alias("n_low"))


def _unpivot(row: DataFrame, table: str, checks: list) -> DataFrame:
    """One-row aggregate -> one report row per check, in the given order.
    ``checks``: ``(name, n_bad column, fatal, message column)``."""
    parts = ", ".join(
        f"'{name}', CAST({n_bad} AS BIGINT), {str(fatal).lower()}, {msg}" for name, n_bad, fatal, msg in checks
    )
    return row.selectExpr(f"stack({len(checks)}, {parts}) as (check, n_bad, fatal, message)").select(
        F.lit(table).alias("table"), "check", "n_bad", "fatal", "message"
    )


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _movie_report(row: DataFrame) -> DataFrame:
    return _unpivot(row, "movies", [
        ("nulls", "n_nulls", True, _sql_str(MSG_NULL_MOVIES)),
        ("duplicate_ids", "dup_ids", True, _sql_str(MSG_DUP_IDS)),
        ("duplicate_titles", "dup_titles", False, _sql_str("duplicate titles (warning)")),
    ])


def _rating_report(row: DataFrame, floor: int) -> DataFrame:
    return _unpivot(row, "ratings", [
        ("nulls", "n_nulls", True, _sql_str(MSG_NULL_RATINGS)),
        ("unknown_movies", "orphans", True, _sql_str(MSG_RATING_ORPHANS)),
        ("rating_range", "bad_range", True, _sql_str(MSG_RANGE)),
        ("user_activity", "n_low", True, _sql_str(MSG_ACTIVITY.format(n=int(floor)))),
    ])


def _tag_report(row: DataFrame) -> DataFrame:
    return _unpivot(row, "tags", [
        ("nulls", "n_nulls", True, _sql_str(MSG_NULL_TAGS)),
        ("unknown_movies", "orphans", True, "orphan_msg"),
    ])


def _movie_checks(movies: DataFrame) -> list:
    """Nulls, duplicate ids and duplicate titles in one scan."""
    per_col = [F.count_if(F.col(c).isNull()) for c in movies.columns]
    row = movies.agg(
        reduce(lambda a, b: a + b, per_col).alias("n_nulls"),
        (F.count(F.lit(1)) - F.countDistinct("movieId")).alias("dup_ids"),
        (F.count(F.lit(1)) - F.countDistinct("title")).alias("dup_titles"),
    )
    return [_movie_report(row)]


def _rating_checks(ratings: DataFrame, movies: DataFrame, floor: int, lo: float, hi: float) -> list:
    """Nulls and range in one scan; unknown movies (anti join) and user
    activity (grouping) enter as scalar subqueries."""
    per_col = [F.count_if(F.col(c).isNull()) for c in ratings.columns]
    orphans = orphan_count(ratings, movies).scalar()
    low = low_activity_users(ratings, floor).scalar()
    row = ratings.agg(
        reduce(lambda a, b: a + b, per_col).alias("n_nulls"),
        F.min("rating").alias("mn"),
        F.max("rating").alias("mx"),
    ).select(
        "n_nulls",
        orphans.alias("orphans"),
        F.when(F.coalesce((F.col("mn") < F.lit(lo)) | (F.col("mx") > F.lit(hi)), F.lit(True)), 1)
        .otherwise(0)
        .alias("bad_range"),
        low.alias("n_low"),
    )
    return [_rating_report(row, floor)]


def _tag_checks(tags: DataFrame, movies: DataFrame) -> list:
    per_col = [F.count_if(F.col(c).isNull()) for c in tags.columns]
    orphans = orphan_count(tags, movies).scalar()
    row = tags.agg(reduce(lambda a, b: a + b, per_col).alias("n_nulls")).select(
        "n_nulls",
        orphans.alias("orphans"),
        F.format_string(MSG_TAG_ORPHANS.replace("{n}", "%d"), orphans).alias("orphan_msg"),
    )
    return [_tag_report(row)]


def validation_report(
    movies: DataFrame,
    ratings: DataFrame,
    tags: DataFrame,
    min_ratings_per_user: int = MIN_RATINGS_PER_USER,
    min_rating: float = MIN_RATING,
    max_rating: float = MAX_RATING,
) -> DataFrame:
    """V8: all checks as ``(table, check, n_bad, fatal, message)``, in the
    order the reference runs them. An empty ratings table is reported as a
    range failure (Q13) instead of failing on a null comparison."""
    rows = (
        _movie_checks(movies)
        + _rating_checks(ratings, movies, min_ratings_per_user, min_rating, max_rating)
        + _tag_checks(tags, movies)
    )
    return reduce(DataFrame.unionByName, rows)


def write_observed(df: DataFrame, path: str, bounds: tuple[str, ...] = ()) -> dict:
    """Writes ``df`` as Parquet and counts on the way: rows, nulls summed over
    every column, and the least and greatest value of the ``bounds`` columns.
    The counts are metrics of the write (``DataFrame.observe``), so the rows
    are read once."""
    seen = Observation()
    nulls = reduce(lambda a, b: a + b, (F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns))
    ends = [f(F.col(f"`{c}`")).alias(f"{n}_{c}") for c in bounds for n, f in (("min", F.min), ("max", F.max))]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"), *ends).write.parquet(path)
    return seen.get


def report_on_write(
    movies: DataFrame,
    ratings: DataFrame,
    tags: DataFrame,
    folder: str,
    min_ratings_per_user: int = MIN_RATINGS_PER_USER,
    min_rating: float = MIN_RATING,
    max_rating: float = MAX_RATING,
) -> DataFrame:
    """V8 while the raw tables are written to ``folder`` (``movies``,
    ``ratings``, ``tags``): the rows of :func:`validation_report`.

    Nulls and ranges are metrics of the writes. What has to compare rows with
    each other (repeats, unknown ids, activity) reads the columns it needs of
    the written tables.
    """
    spark, folder = movies.sparkSession, folder.rstrip("/")
    m = write_observed(movies, f"{folder}/movies")
    r = write_observed(ratings, f"{folder}/ratings", ("rating",))
    t = write_observed(tags, f"{folder}/tags")
    movies, ratings, tags = (spark.read.parquet(f"{folder}/{x}") for x in ("movies", "ratings", "tags"))
    ends = r["min_rating"], r["max_rating"]
    bad_range = int(None in ends or ends[0] < min_rating or ends[1] > max_rating)
    lone = spark.range(1)
    ids = movies.agg(F.countDistinct("movieId").alias("ids"), F.countDistinct("title").alias("titles"))
    movie_row = ids.select(F.lit(m["nulls"]).alias("n_nulls"), (F.lit(m["rows"]) - F.col("ids")).alias("dup_ids"), (F.lit(m["rows"]) - F.col("titles")).alias("dup_titles"))
    rating_row = lone.select(F.lit(r["nulls"]).alias("n_nulls"), F.lit(bad_range).alias("bad_range"),
                             orphan_count(ratings, movies).scalar().alias("orphans"), low_activity_users(ratings, min_ratings_per_user).scalar().alias("n_low"))
    tag_row = lone.select(F.lit(t["nulls"]).alias("n_nulls"), orphan_count(tags, movies).scalar().alias("orphans"))
    rows = [_movie_report(movie_row), _rating_report(rating_row, min_ratings_per_user),
            _tag_report(tag_row.withColumn("orphan_msg", F.format_string(MSG_TAG_ORPHANS.replace("{n}", "%d"), F.col("orphans"))))]
    return reduce(DataFrame.unionByName, rows)


def _raise_first(checks: list, table: str) -> None:
    """Collect the few report rows of one table; raise the first failure."""
    for r in reduce(DataFrame.unionByName, checks).collect():
        if r["n_bad"] > 0 and r["fatal"]:
            raise ValueError(r["message"])
        if r["n_bad"] > 0:
            log.warning("%s: %s %s", table, r["check"], r["n_bad"])


def validate_movies(movies: DataFrame) -> None:
    """Raise on nulls in any column or repeated movieIds; warn on titles."""
    _raise_first(_movie_checks(movies), "movies")


def validate_ratings(
    ratings: DataFrame,
    movies: DataFrame,
    min_ratings_per_user: int = MIN_RATINGS_PER_USER,
    min_rating: float = MIN_RATING,
    max_rating: float = MAX_RATING,
) -> None:
    """Raise on nulls, unknown movies, out-of-range ratings, or users with
    fewer than ``min_ratings_per_user`` ratings (first failure wins)."""
    _raise_first(_rating_checks(ratings, movies, min_ratings_per_user, min_rating, max_rating), "ratings")


def validate_tags(tags: DataFrame, movies: DataFrame) -> None:
    """Raise on nulls or unknown movies in tags."""
    _raise_first(_tag_checks(tags, movies), "tags")
