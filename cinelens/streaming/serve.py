"""Recommendation requests served by Structured Streaming (R8 re-aimed).

The reference answers one HTTP request at a time from a model loaded once.
Here requests arrive as a stream of rows ``(request_id, userId, k)`` (files
landing in a folder, or any streaming source). Two forms:

- :func:`serve`: ``foreachBatch`` scores the users of each micro-batch in
  one job (the blocked kernel scores only those users);
- :func:`serve_precomputed`: every user is scored once in batch
  (:func:`precompute`), and the stream answers with equi-joins, no per-request
  work beyond the joins.

Both are exact for each request's own k, whatever it is: a top-k ranked list
is a prefix of a longer one, while the popular list (cold start) and top-up
rows depend on k and are precomputed per k up to a depth (``max_k^2 / 2``
rows); deeper requests are scored. Unknown users get the popular list, as the
service does. The streams keep no state; exactly-once output comes from
checkpointed source offsets and sinks that a replayed batch overwrites.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelens.operators.joins import ID_ROW_BYTES, broadcast_if_small
from cinelens.operators.recommend import METADATA_ROW_BYTES

REQUEST_SCHEMA = "request_id string, userId long, k int"
ANSWER_SCHEMA = "request_id string, userId long, rank int, movieId long, title string, genres string"
ANSWER = ["request_id", "userId", "rank", "movieId", "title", "genres"]
#: k of a request that names none.
DEFAULT_K = 10


def _requests(requests: DataFrame) -> DataFrame:
    return requests.select("request_id", "userId", F.coalesce(F.col("k"), F.lit(DEFAULT_K)).alias("k"))


def answer_requests(model, requests: DataFrame) -> DataFrame:
    """Batch form: ``(request_id, userId, rank, movieId, title, genres)`` for
    each request, whatever its k (null: 10).

    Requests are answered by distinct k, one scoring pass each over the users
    that asked for it, so that a single deep request does not deepen all."""
    req = _requests(requests)
    # As many values as the batch has different k.
    depths = sorted(r["k"] for r in req.select("k").distinct().collect())
    parts = []
    for k in depths:
        asked = req.filter(F.col("k") == k)
        if k > 0:
            recs = model.recommend(asked.select("userId"), int(k)).select("userId", "rank", "movieId", "title", "genres")
            parts.append(asked.join(recs, "userId").select(*ANSWER))
    if not parts:
        return requests.sparkSession.createDataFrame([], ANSWER_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def serve(
    spark: SparkSession,
    model,
    request_dir: str,
    sink_path: str,
    checkpoint_path: str,
    trigger_seconds: int | None = None,
):
    """Start the stream: parquet request files in ``request_dir`` ->
    answers appended as parquet under ``sink_path`` (one folder per batch,
    overwritten on replay, so a retried batch does not duplicate rows)."""
    return _start(spark, lambda batch: answer_requests(model, batch), request_dir, sink_path, checkpoint_path, trigger_seconds)


def _start(spark, answer, request_dir, sink_path, checkpoint_path, trigger_seconds):
    requests = spark.readStream.schema(REQUEST_SCHEMA).parquet(request_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            answer(batch).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_path)
    if trigger_seconds:
        writer = writer.trigger(processingTime=f"{int(trigger_seconds)} seconds")
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


@dataclass
class ServingTables:
    """Static side of request serving, exact for every ``k <= max_k``.

    ``ranked``: per warm user the cosine-ranked unseen rows (a top-k list
    is a prefix of a longer one); ``warm``: users with a profile;
    ``topup``: for users whose ranked list is shorter than ``max_k``, the
    top-up rows of each ``k`` (``popular(k - L)`` minus seen, catalogue
    order), at most ``max_k^2 / 2`` rows per such user; ``cold``: the
    popular list of each ``k`` in catalogue order (``max_k^2 / 2`` rows).
    """

    ranked: DataFrame
    warm: DataFrame
    topup: DataFrame
    cold: DataFrame


def precompute(model, users: DataFrame, max_k: int = 30) -> ServingTables:
    """One batch job over ``users``; every table is checkpointed."""
    from pyspark.sql import Window

    n = int(max_k)
    recs = model.recommend(users, n)
    meta = model.movies.select("movieId", "title", "genres")
    ranked = recs.filter(F.col("source") == "profile").select("userId", "rank", "movieId", "title", "genres")
    warm = model.profiles.join(users.select("userId").distinct(), "userId", "left_semi").select("userId")
    lengths = warm.join(ranked.groupBy("userId").agg(F.count(F.lit(1)).alias("L")), "userId", "left").select(
        "userId", F.coalesce(F.col("L"), F.lit(0)).alias("L")
    )
    pop = model.popular(n).select("movieId", "pop_rank")
    ks = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("k")

    # Cold: for each k, popular(k) in catalogue order.
    cold = (
        pop.select("movieId", "pop_rank", ks)
        .filter(F.col("pop_rank") <= F.col("k"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("movieId")))
        .join(broadcast_if_small(meta.join(pop.select("movieId"), "movieId", "left_semi"), n, METADATA_ROW_BYTES), "movieId")
        .select("k", "rank", "movieId", "title", "genres")
    )

    # Top-up: for short lists and each k > L, popular(k - L) minus seen.
    seen = model.ratings.select("userId", "movieId").distinct()
    short = lengths.filter(F.col("L") < n)
    cands = (
        short.select("userId", "L", F.explode(F.sequence(F.lit(1), F.lit(n) - F.col("L"))).alias("pop_rank"))
        .join(broadcast_if_small(pop, n, ID_ROW_BYTES), "pop_rank")
        .join(seen, ["userId", "movieId"], "left_anti")
    )
    per_k = cands.select("userId", "L", "movieId", "pop_rank", ks).filter(
        (F.col("k") > F.col("L")) & (F.col("pop_rank") <= F.col("k") - F.col("L"))
    )
    topup = (
        per_k.withColumn(
            "rank", F.col("L") + F.row_number().over(Window.partitionBy("userId", "k").orderBy("movieId"))
        )
        .join(meta, "movieId", "left")
        .select("userId", "k", "rank", "movieId", "title", "genres")
    )
    return ServingTables(
        ranked.checkpoint(eager=True),
        warm.checkpoint(eager=True),
        topup.checkpoint(eager=True),
        cold.checkpoint(eager=True),
    )


def answer_from_lists(requests: DataFrame, tables: ServingTables, max_k: int = 30) -> DataFrame:
    """Equi-joins with the precomputed lists (no window, no state), for
    requests ``(request_id, userId, k)`` with k up to ``max_k``, the depth of
    the tables: the user's ranked rows with ``rank <= k`` and the top-up rows
    of that ``k``; a user without a profile gets the cold list of that ``k``.
    Works on a streaming or a batch ``requests``. Deeper requests have no rows
    here; :func:`serve_precomputed` answers them by scoring. The cold table has
    ``max_k^2 / 2`` rows, so it is broadcast on a checked size."""
    req = _requests(requests).filter(F.col("k") <= max_k)
    tagged = req.join(tables.warm.withColumn("_warm", F.lit(True)), "userId", "left")
    warm_req = tagged.filter(F.col("_warm").isNotNull())
    ranked = warm_req.join(tables.ranked, "userId").filter(F.col("rank") <= F.col("k")).select(*ANSWER)
    topped = warm_req.join(tables.topup, ["userId", "k"]).select(*ANSWER)
    lists = broadcast_if_small(tables.cold, max_k * (max_k + 1) // 2, METADATA_ROW_BYTES)
    cold = tagged.filter(F.col("_warm").isNull()).join(lists, "k").select(*ANSWER)
    return ranked.unionByName(topped).unionByName(cold)


def serve_precomputed(
    spark: SparkSession,
    model,
    tables: ServingTables,
    request_dir: str,
    sink_path: str,
    checkpoint_path: str,
    max_k: int = 30,
    trigger_seconds: int | None = None,
):
    """Start a stream answering requests from precomputed lists; those deeper
    than the lists (``k > max_k``) are scored by the model."""

    def answer(batch: DataFrame) -> DataFrame:
        deep = batch.filter(F.col("k") > max_k)
        out = answer_from_lists(batch, tables, max_k)
        return out if deep.isEmpty() else out.unionByName(answer_requests(model, deep))

    return _start(spark, answer, request_dir, sink_path, checkpoint_path, trigger_seconds)
