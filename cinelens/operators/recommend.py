"""Recommendation operators R2-R10 for any set of users in one job.

Output of :func:`recommend_users`: ``(userId, rank, movieId, title, genres,
similarity, source)`` where ``source`` is ``profile`` (ranked by cosine),
``top_up`` (R3, similarity 0.0) or ``popular`` (R7 cold start, 0.0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.functions.vectors import cosine, entries, is_sparse, l2_norm
from cinelens.operators.joins import ID_ROW_BYTES, broadcast_if_small
from cinelens.operators.ordering import numbered
from cinelens.operators.profiles import centroid, liked
from cinelens.operators.scoring import rank_order, top_n_unseen
from cinelens.session import ensure_checkpoint_dir

# Conservative size of one metadata row (id, title, genres) when broadcast.
METADATA_ROW_BYTES = 256
# Longest popular list numbered by a window in one task.
WINDOW_ROWS = 100_000


def _centroid_similarity(items: DataFrame) -> DataFrame:
    """``(movieId, similarity)`` of every item to the centroid of all."""
    if not is_sparse(items):
        center = centroid(items).scalar()
        beside = items.select("movieId", "vec", center.alias("_center"))
        return beside.select("movieId", cosine("vec", "_center").alias("similarity"))
    center = centroid(items)
    length = center.agg(F.sqrt(F.sum(F.col("c") * F.col("c")))).scalar()
    each = items.select("movieId", F.explode(entries("vec")).alias("e")).select("movieId", "e.idx", "e.val")
    dots = each.join(center, "idx").groupBy("movieId").agg(F.sum(F.col("val") * F.col("c")).alias("dot"))
    norm = items.select("movieId", l2_norm("vec.val").alias("norm"))
    both = F.col("norm") * length
    return norm.join(dots, "movieId", "left").select(
        "movieId", F.when(both > 0, F.coalesce("dot", F.lit(0.0)) / both).otherwise(F.lit(0.0)).alias("similarity"))


def popular(items: DataFrame, n: int, dims: int) -> DataFrame:
    """The ``n`` items closest (cosine) to the centroid of all items.

    ``(movieId, pop_rank, cat_rank, similarity)``: ``pop_rank`` orders by
    similarity, ``cat_rank`` by movieId, the order the reference returns
    them in (Q3). Not based on rating counts. The centroid (A9, one grouped
    aggregate) enters as a scalar subquery (dense) or a join on the term
    (sparse); ties follow the users' ranking rule. A short list is numbered by
    windows over its ``n`` rows, a long one by range partitionings.
    """
    near, n = _centroid_similarity(items), int(n)
    if n > WINDOW_ROWS:
        ranked = numbered(near, *rank_order(), name="pop_rank").filter(F.col("pop_rank") < n)
        return numbered(ranked, "movieId", name="cat_rank").select(
            "movieId", (F.col("pop_rank") + 1).alias("pop_rank"), (F.col("cat_rank") + 1).alias("cat_rank"), "similarity")
    top = near.orderBy(*rank_order()).limit(n)
    return top.select(
        "movieId",
        F.row_number().over(Window.orderBy(*rank_order())).alias("pop_rank"),
        F.row_number().over(Window.orderBy("movieId")).alias("cat_rank"),
        "similarity",
    )


def _metadata(movies: DataFrame, n_rows: int | None = None) -> DataFrame:
    """``(movieId, title, genres)``, broadcast when the catalogue fits (J4):
    the table it meets has a row per recommendation, the largest output of
    the job, and should not be shuffled for a lookup. ``n_rows`` is a known
    row count (else the catalogue is counted)."""
    meta = movies.select("movieId", "title", "genres")
    n = meta.count() if n_rows is None else n_rows
    return broadcast_if_small(meta, n, METADATA_ROW_BYTES)


def seen_pairs(ratings: DataFrame) -> DataFrame:
    """P5: distinct ``(userId, movieId)`` pairs (hashed on both columns)."""
    return ratings.select("userId", "movieId").distinct()


def short_lists(users: DataFrame, items: DataFrame, seen: DataFrame, n: int, n_items: int) -> DataFrame:
    """``(userId, L)`` of the ``users(userId)`` whose ranked list has ``L < n``
    rows, without ranking anything.

    A list holds every unseen item as long as there is room, so ``L`` is the
    catalogue's size less the user's different seen items in it. Only users
    with enough rows in ``seen(userId, movieId)`` to be short are counted.
    """
    if n <= n_items:
        often = seen.groupBy("userId").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > n_items - n)
        users = users.join(often, "userId", "left_semi").checkpoint(eager=True)
    known = seen.join(users, "userId", "left_semi").join(items.select("movieId"), "movieId", "left_semi").distinct()
    counts = known.groupBy("userId").agg(F.count(F.lit(1)).alias("c"))
    length = F.lit(n_items) - F.coalesce("c", F.lit(0))
    return users.join(counts, "userId", "left").select("userId", length.alias("L")).filter(F.col("L") < n)


def top_up(users: DataFrame, items: DataFrame, ratings: DataFrame, n: int, n_items: int, pop: DataFrame) -> DataFrame:
    """R3 for ``users(userId)`` with a profile: ``(userId, rank, movieId,
    similarity, source)`` of the rows that follow a list of ``L < n``:
    ``popular(n - L)`` minus seen, in catalogue order. ``pop`` is
    ``popular(n)``."""
    short = short_lists(users, items, ratings.select("userId", "movieId"), n, n_items).checkpoint(eager=True)
    # Ratings meet the top-up rows only for users whose list is short.
    seen = seen_pairs(ratings.join(broadcast_if_small(short.select("userId"), short.count(), ID_ROW_BYTES), "userId", "left_semi"))
    wanted = F.least(F.lit(n) - F.col("L"), F.lit(n_items))
    fill = short.filter(wanted > 0).select("userId", "L", F.explode(F.sequence(F.lit(1).cast("long"), wanted.cast("long"))).alias("pop_rank"))
    listed = broadcast_if_small(pop.select(F.col("pop_rank").cast("long").alias("pop_rank"), "movieId"), min(n, n_items), ID_ROW_BYTES)
    fill = fill.join(listed, "pop_rank").join(seen, ["userId", "movieId"], "left_anti")
    return fill.select(
        "userId",
        (F.col("L") + F.row_number().over(Window.partitionBy("userId").orderBy("movieId"))).alias("rank"),
        "movieId",
        F.lit(0.0).alias("similarity"),
        F.lit("top_up").alias("source"),
    )


def with_metadata(recs: DataFrame, movies: DataFrame, n_movies: int | None = None) -> DataFrame:
    """List rows with title and genres."""
    return recs.join(_metadata(movies, n_movies), "movieId", "left").select(
        "userId", "rank", "movieId", "title", "genres", "similarity", "source"
    )


def recommend_users(
    users: DataFrame,
    profiles: DataFrame,
    items: DataFrame,
    ratings: DataFrame,
    movies: DataFrame,
    n: int,
    dims: int,
    dedupe_top_up: bool = False,
    n_movies: int | None = None,
) -> DataFrame:
    """R2 + R3 + R7 (+ J4) for every user in ``users(userId)``.

    Warm users (with a profile): unseen items by cosine, top ``n`` (P6,
    T3). A list shorter than ``n`` is topped up (R3) from ``popular(n - L)``
    minus seen, in catalogue order. Such a list holds every unseen item, so
    the rows added repeat listed ones (parity, Q2), and with
    ``dedupe_top_up=True`` there are none. Cold users get ``popular(n)`` in
    catalogue order, seen items not excluded (Q4).
    ``ratings`` gives the seen sets, ``movies`` the metadata (R10);
    ``n_movies`` its row count when known.
    """
    n = int(n)
    # Read by the warm/cold split, the grid sizing and the kernel: the
    # distinct user set is written once instead of re-derived per use.
    ensure_checkpoint_dir(profiles.sparkSession)
    users = users.select("userId").distinct().checkpoint(eager=True)
    warm = profiles.join(users, "userId", "left_semi")
    n_items = items.count()
    # Masking a seen item twice is harmless: no distinct before the kernel.
    top = top_n_unseen(warm, items, ratings.select("userId", "movieId"), n, dims)
    pop = popular(items, n, dims)

    recs = top.select("userId", "rank", "movieId", "similarity", F.lit("profile").alias("source"))
    if not dedupe_top_up:
        recs = recs.unionByName(top_up(warm.select("userId"), items, ratings, n, n_items, pop))
    listed = pop.select(F.col("cat_rank").cast("long").alias("rank"), "movieId")
    cold = (
        users.join(profiles, "userId", "left_anti")
        .select("userId", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(min(n, n_items)).cast("long"))).alias("rank"))
        .join(broadcast_if_small(listed, min(n, n_items), ID_ROW_BYTES), "rank")
        .select("userId", "rank", "movieId", F.lit(0.0).alias("similarity"), F.lit("popular").alias("source"))
    )
    return with_metadata(recs.unionByName(cold), movies, n_movies)


def liked_movies(ratings: DataFrame, movies: DataFrame, threshold: float, n_movies: int | None = None) -> DataFrame:
    """Per user the movies rated ``>= threshold``, once each, with
    metadata: ``(userId, movieId, title, genres)``; sort by movieId for the
    reference's catalogue order."""
    ids = liked(ratings, threshold).select("userId", "movieId").distinct()
    return ids.join(_metadata(movies, n_movies), "movieId", "inner").select(
        "userId", "movieId", "title", "genres"
    )
