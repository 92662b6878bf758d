"""Block layout for vector search: shards of candidates against blocks of
queries.

The query set is a stated part of the table, so the work is queries times
candidates, done in blocks: rows are dealt to shards by a hash of the id and
queries to blocks likewise; each (shard, block) pair is one group, holding
``shard_rows + block_rows`` vectors or so whatever the table's size, and each
side is copied once for each group of the other side's count. A group sends
its k best for each query, and a window over (query) of shards * k rows takes
the best of all.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.llm.common import prepare
from cinelens.session import stored


def clean(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec (array<double>)`` of the usable rows: id and vector not
    null, not empty, every component finite. Rows that repeat an id count
    once, with the smallest of their vectors."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", fine))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def blocks(rows: DataFrame, is_query, shard_rows: int, block_rows: int):
    """Candidates and queries, copied to the groups (dims, shard, block)."""
    rows = rows.withColumn("dims", F.size("vec"))
    queries = rows.filter(is_query)
    shards = max(1, math.ceil(rows.count() / shard_rows))
    parts = max(1, math.ceil(queries.count() / block_rows))
    shard = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(parts))
    candidates = rows.withColumn("shard", shard).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    asked = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    return candidates, asked, shards * parts


def search(rows: DataFrame, is_query, within: Callable, k: int, best_first, shard_rows: int, block_rows: int, score: str) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best of every query.

    ``within(candidate ids, candidates, query ids, queries)`` gives arrays
    (place of the query, candidate id, score) with the k best in one group;
    scores are ``score`` (a numpy type) or Python's integers, of which those
    that a long can't hold become null.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows, kind, limit = stored(rows), "Int64" if score == "int64" else "float64", (1 << 63) - 1
    candidates, asked, groups = blocks(rows, is_query, shard_rows, block_rows)

    def run(left, right):
        import numpy as np
        import pandas as pd

        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0, score), "over": np.empty(0, np.int64)})
        if not len(left) or not len(right):
            return empty
        left, right = left.sort_values("vec_id"), right.sort_values("vec_id")
        ids, asked_ids = left["vec_id"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        at, found, value = within(ids, np.stack(left["vec"].to_numpy()), asked_ids, np.stack(right["vec"].to_numpy()))
        # Python's integers where 64 bits may not do.
        over = [(x > limit) - (x < -limit) for x in value] if value.dtype == object else 0
        value = [x if -limit <= x <= limit else None for x in value] if value.dtype == object else value
        return pd.DataFrame({"query_id": asked_ids[at], "vec_id": found, "score": pd.array(value, kind), "over": over})

    key = ["dims", "shard", "block"]
    pairs = candidates.repartition(groups, *key).groupBy(*key).cogroup(asked.repartition(groups, *key).groupBy(*key))
    found = pairs.applyInPandas(run, f"query_id long, vec_id long, score {'long' if score == 'int64' else 'double'}, over long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(best_first(F.col("over")), best_first(F.col("score")), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
