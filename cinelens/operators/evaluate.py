"""Leave-one-out evaluation E1-E9 as one set of joins over all users.

The reference loops over sampled users in Python and scans the ratings once
per user. Here every step is a DataFrame over all sampled users at once:

- E1 eligible users: liked rows per user ``>= min_liked`` (A6);
- E2 sample: the ``max_users`` users with the smallest
  ``md5("<seed>:<userId>")`` (a global top-k; the draw is reproducible in
  any engine with md5);
- E3 hold-out: per user the liked row with the smallest
  ``md5("<seed>:<userId>:<movieId>:<epoch>:<rating %.6f>")``; identical
  rows are counted, and one copy is held out;
- E4 profile from the remaining liked rows, each weighted by the user's
  last rating of that movie (latest timestamp, then highest rating: Q14);
  unknown movies are skipped; users left with none are not evaluated;
- E5 top-k unseen by the blocked kernel with every rated movie excluded;
- E6 HitRate@k (0 by construction, Q1) and an unmasked HitRate@k that does
  not exclude the held-out movie; E7 Coverage@k = distinct / total
  recommendations (Q19); E8 one result row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelens.config import EVAL_MAX_USERS, EVAL_MIN_LIKED, EVAL_SEED, RATING_THRESHOLD, TOP_K
from cinelens.functions.time import epoch_seconds
from cinelens.operators.joins import ID_ROW_BYTES, broadcast_if_small, vector_rows
from cinelens.operators.profiles import weighted_profiles
from cinelens.operators.scoring import top_n_unseen
from cinelens.session import ensure_checkpoint_dir


class Evaluation(NamedTuple):
    result: DataFrame
    lists: DataFrame
    users: DataFrame


def _epoch(df: DataFrame, col: str = "timestamp"):
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return epoch_seconds(col)
    if isinstance(dt, T.TimestampType):
        return F.unix_seconds(F.col(col))
    return F.col(col).cast("bigint")


def eligible_users(ratings: DataFrame, threshold: float = RATING_THRESHOLD, min_liked: int = EVAL_MIN_LIKED) -> DataFrame:
    """E1 (P3, A6): ``(userId, n_liked)`` with ``n_liked >= min_liked``."""
    liked = ratings.filter(F.col("rating") >= F.lit(float(threshold)))
    per_user = liked.groupBy("userId").agg(F.count(F.lit(1)).alias("n_liked"))
    return per_user.filter(F.col("n_liked") >= F.lit(int(min_liked)))


def user_draw_key(seed: int):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("userId").cast("string")))


def sample_users(eligible: DataFrame, max_users: int | None = EVAL_MAX_USERS, seed: int = EVAL_SEED) -> DataFrame:
    """At most ``max_users`` users, no replacement, seeded: ``(userId)``.

    The limit is the feature (a sampling operator); Spark runs it as a
    per-partition top-k and a merge of ``max_users`` rows per partition.
    """
    keyed = eligible.select("userId", user_draw_key(seed).alias("_k"))
    if max_users is None:
        return keyed.select("userId")
    return keyed.orderBy("_k", "userId").limit(int(max_users)).select("userId")


def liked_rows(ratings: DataFrame, users: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Liked rows of ``users`` grouped into identical rows with a count and
    a draw key: ``(userId, movieId, rating, epoch, copies, _h)``."""
    liked = ratings.filter(F.col("rating") >= F.lit(float(threshold))).join(users, "userId", "left_semi")
    rows = liked.select("userId", "movieId", "rating", _epoch(liked).alias("epoch"))
    grouped = rows.groupBy("userId", "movieId", "rating", "epoch").agg(F.count(F.lit(1)).alias("copies"))
    key = F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            F.col("userId").cast("string"),
            F.col("movieId").cast("string"),
            F.col("epoch").cast("string"),
            F.format_string("%.6f", F.col("rating")),
        )
    )
    return grouped.withColumn("_h", key)


def holdout(rows: DataFrame) -> DataFrame:
    """Per user the row with the smallest draw key:
    ``(userId, held_movieId, held_rating, held_epoch)``."""
    pick = rows.groupBy("userId").agg(F.min_by(F.struct("movieId", "rating", "epoch", "_h"), F.col("_h")).alias("p"))
    return pick.select(
        "userId",
        F.col("p.movieId").alias("held_movieId"),
        F.col("p.rating").alias("held_rating"),
        F.col("p.epoch").alias("held_epoch"),
    )


def train_profiles(rows: DataFrame, held: DataFrame, items: DataFrame, dims: int | None = None) -> DataFrame:
    """Profiles from the liked rows minus one copy of the held-out row.

    Each remaining row weighs the user's last rating of its movie among
    the remaining rows (Q14); weights summing to zero fall back to the
    plain mean (Q20).
    """
    is_held = (
        (F.col("movieId") == F.col("held_movieId"))
        & (F.col("rating") == F.col("held_rating"))
        & (F.col("epoch") == F.col("held_epoch"))
    )
    remaining = (
        rows.join(held, "userId")
        .select("userId", "movieId", "rating", "epoch", (F.col("copies") - F.when(is_held, 1).otherwise(0)).alias("n"))
        .filter(F.col("n") > 0)
    )
    # The last rating is taken over the training rows (the held-out copy
    # no longer counts), and weighs every remaining copy of the movie.
    per_movie = remaining.groupBy("userId", "movieId").agg(
        F.sum("n").alias("n"), F.max_by("rating", F.struct("epoch", "rating")).alias("last_rating")
    )
    if dims is not None:
        items = broadcast_if_small(items, *vector_rows(items, dims))
    weighted = per_movie.join(items, "movieId", "inner").select(
        "userId", "vec", F.col("n").cast("double").alias("n"), (F.col("n") * F.col("last_rating")).alias("w")
    )
    return weighted_profiles(weighted, "w", "n")


def evaluate_leave_one_out(
    items: DataFrame,
    ratings: DataFrame,
    dims: int,
    like_threshold: float = RATING_THRESHOLD,
    min_liked: int = EVAL_MIN_LIKED,
    k: int = TOP_K,
    max_users: int | None = EVAL_MAX_USERS,
    seed: int = EVAL_SEED,
) -> Evaluation:
    """E1-E8 over a sample of ``max_users`` users, or over all (``None``).

    ``result`` is one row ``(hit_rate_at_k, n_users, k, coverage_at_k,
    hit_rate_at_k_unmasked)``; ``lists`` has ``(userId, rank, movieId,
    similarity, held_movieId)`` of the masked top-k lists; ``users`` has a row
    ``(userId, hit, hit_unmasked)`` for each evaluated user, however many
    (:func:`record` makes the one-row form with an array of ids).
    """
    users = sample_users(eligible_users(ratings, like_threshold, min_liked), max_users, seed)
    rows = liked_rows(ratings, users, like_threshold, seed)
    held = holdout(rows)
    prof = train_profiles(rows, held, items, dims)

    # One scoring pass: exclude seen minus the held-out movie, keep k + 1.
    # Restrict to the evaluated users first (at most max_users ids, broadcast
    # when bounded), then deduplicate: no distinct over the whole table.
    ensure_checkpoint_dir(prof.sparkSession)
    prof = prof.checkpoint(eager=True)
    evaluated_ids = broadcast_if_small(prof.select("userId"), prof.count(), ID_ROW_BYTES)
    seen = ratings.join(evaluated_ids, "userId", "left_semi").select("userId", "movieId").distinct()
    seen_but_held = seen.join(
        held.select("userId", F.col("held_movieId").alias("movieId")), ["userId", "movieId"], "left_anti"
    )
    wide = top_n_unseen(prof, items, seen_but_held, int(k) + 1, dims).join(held, "userId")
    unmasked = wide.filter(F.col("rank") <= int(k))
    # Masked list: the same ranking without the held-out movie (at most
    # k + 1 rows per user, so the renumbering window is bounded).
    renumber = Window.partitionBy("userId").orderBy("rank")
    lists = (
        wide.filter(F.col("movieId") != F.col("held_movieId"))
        .withColumn("rank", F.row_number().over(renumber))
        .filter(F.col("rank") <= int(k))
        .select("userId", "rank", "movieId", "similarity", "held_movieId")
    )

    evaluated = prof.select("userId")
    hits = lists.filter(F.col("movieId") == F.col("held_movieId")).select("userId").distinct()
    hits_unmasked = unmasked.filter(F.col("movieId") == F.col("held_movieId")).select("userId").distinct()
    per_user = (
        evaluated.join(hits.withColumn("hit", F.lit(1)), "userId", "left")
        .join(hits_unmasked.withColumn("hit_u", F.lit(1)), "userId", "left")
        .select("userId", F.coalesce("hit", F.lit(0)).alias("hit"), F.coalesce("hit_u", F.lit(0)).alias("hit_u"))
    )
    user_part = per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.sum("hit").alias("hits"),
        F.sum("hit_u").alias("hits_u"),
    )
    cover = lists.agg(F.countDistinct("movieId").alias("n_distinct"), F.count(F.lit(1)).alias("n_recs"))
    result = user_part.select(
        F.when(F.col("n_users") > 0, F.col("hits") / F.col("n_users")).otherwise(F.lit(0.0)).alias("hit_rate_at_k"),
        F.col("n_users").cast("bigint").alias("n_users"),
        F.lit(int(k)).alias("k"),
        F.when(cover.select("n_recs").scalar() > 0,
               cover.select("n_distinct").scalar() / cover.select("n_recs").scalar())
        .otherwise(F.lit(0.0)).alias("coverage_at_k"),
        F.when(F.col("n_users") > 0, F.col("hits_u") / F.col("n_users")).otherwise(F.lit(0.0)).alias(
            "hit_rate_at_k_unmasked"
        ),
    )
    return Evaluation(result, lists, per_user.withColumnRenamed("hit_u", "hit_unmasked"))


def record(evaluation: Evaluation) -> DataFrame:
    """E8 as one row: the result with ``users_evaluated``, the sorted ids.
    For a bounded sample; of an evaluation of all users read ``users``."""
    ids = evaluation.users.agg(F.array_sort(F.collect_list("userId")).alias("users_evaluated")).scalar()
    return evaluation.result.select(
        "hit_rate_at_k", "n_users", "k", "coverage_at_k", ids.alias("users_evaluated"), "hit_rate_at_k_unmasked")
