"""Preparation stage: P1, P2, A1-A4, N1-N3 and the stage function.

Every function is DataFrame -> DataFrame; nothing is collected. Sets of ids
are one-column DataFrames used through semi joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.config import NO_GENRES
from cinelens.functions import text
from cinelens.functions.time import ntz_from_epoch_seconds
from cinelens.operators.joins import ID_ROW_BYTES, ID_SET_LIMIT_BYTES, broadcast_if_small
from cinelens.session import ensure_checkpoint_dir


def drop_no_genres(movies: DataFrame) -> DataFrame:
    """Keep rows whose genres differ from the no-genre marker.

    A null genres value drops too (a comparison with null is not true).
    """
    return movies.filter(F.col("genres") != F.lit(NO_GENRES))


def normalize_genres(movies: DataFrame) -> DataFrame:
    """Genres as a lower-case, space-separated string; column order kept."""
    return movies.withColumn("genres", text.normalize_genres("genres"))


def rating_counts(ratings: DataFrame) -> DataFrame:
    """A1: ``(movieId, rating_count)``, partial + final hash aggregation."""
    return ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("rating_count"))


def merge_duplicate_titles(movies: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A2: one row per title.

    The surviving ``movieId`` is the one with most ratings (J1: a movie with
    no ratings counts 0); ``genres`` independently comes from the row with
    the longest genres text in code points. Ties go to the first row, which
    in an id-ordered catalogue is the smallest movieId.

    Returns ``(movies[title, movieId, genres], valid_ids[movieId])``.
    """
    counted = movies.join(rating_counts(ratings), "movieId", "left").withColumn(
        "rating_count", F.coalesce(F.col("rating_count"), F.lit(0))
    )
    neg_id = -F.col("movieId")
    merged = counted.groupBy("title").agg(
        F.max_by("movieId", F.struct(F.col("rating_count"), neg_id)).alias("movieId"),
        F.max_by("genres", F.struct(F.length("genres"), neg_id)).alias("genres"),
    )
    return merged, merged.select("movieId")


def filter_on_valid_id(df: DataFrame, valid_ids: DataFrame) -> DataFrame:
    """Rows whose movieId is among ``valid_ids`` (left semi join)."""
    return df.join(valid_ids.select("movieId"), "movieId", "left_semi")


def normalize_tag_values(tags: DataFrame) -> DataFrame:
    """N2 without the grouping: the ``tag`` column cleaned in place."""
    return tags.withColumn("tag", text.normalize_tag("tag"))


def join_tags_per_movie(tags: DataFrame) -> DataFrame:
    """A3: per movie, the distinct cleaned tags sorted and joined by a space.

    The distinct step runs first (hashed on movie and tag, with a partial
    step), so a movie with a third of all tag rows reaches the final
    grouping as its distinct values only.
    """
    distinct = tags.select("movieId", "tag").distinct()
    return distinct.groupBy("movieId").agg(
        F.array_join(F.array_sort(F.collect_list("tag")), " ").alias("tag")
    )


def normalize_tag_column(tags: DataFrame) -> DataFrame:
    """N2 + A3: ``(movieId, tag)`` with one joined string per movie."""
    return join_tags_per_movie(normalize_tag_values(tags))


def convert_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Epoch seconds to a naive timestamp (UTC wall clock)."""
    return df.withColumn(column, ntz_from_epoch_seconds(column))


def mark_last_rating_per_user(ratings: DataFrame) -> DataFrame:
    """A4: ``is_last_rating = timestamp == max(timestamp) of the user``.

    Equal latest timestamps flag every such row (Q7). Written as a grouped
    max joined back rather than a window over the user, so one very active
    user is combined map-side. The grouped table is written first: joined to a
    plain table, a very active user's rows are split by AQE, which does not
    split against an aggregate on the join key.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    latest = ratings.groupBy("userId").agg(F.max("timestamp").alias("_latest")).checkpoint(eager=True)
    return (
        ratings.join(latest, "userId", "left")
        .withColumn("is_last_rating", F.col("timestamp") == F.col("_latest"))
        .select(*ratings.columns, "is_last_rating")
    )


def run_data_preparation(
    movies: DataFrame, ratings: DataFrame, tags: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stage: returns ``(movies, tags, ratings)`` prepared, in that order.

    Movies: drop no-genre rows, merge titles (counting raw ratings),
    normalize genres. Tags and ratings keep only surviving ids (ratings of
    a merged-away id are dropped, not moved: Q5).
    """
    merged, valid_ids = merge_duplicate_titles(drop_no_genres(movies), ratings)
    # The id set has at most one row per catalogue movie; bounded by the
    # catalogue's row count (a scan of the catalogue only, not of ratings),
    # it is broadcast into both semi joins when it fits, so neither ratings
    # nor tags are shuffled to be filtered.
    valid_ids = broadcast_if_small(valid_ids, movies.count(), ID_ROW_BYTES, ID_SET_LIMIT_BYTES)
    movies_out = normalize_genres(merged)
    tags_out = normalize_tag_column(filter_on_valid_id(tags, valid_ids))
    ratings_out = mark_last_rating_per_user(convert_timestamp(filter_on_valid_id(ratings, valid_ids)))
    return movies_out, tags_out, ratings_out
