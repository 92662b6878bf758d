"""J10 + P6 + T2-T4: exact top-n unseen items per user by cosine similarity.

Every user must be scored against every item (the reference scores one
profile against the whole catalogue). The work is cut into a grid:

- items fall into ``B`` blocks (hash of movieId), each small enough for one
  task's memory;
- users fall into ``S`` salts (hash of userId), each a bounded group.

``cogroup`` on ``(block, salt)`` gives one task the item block and the
users of one salt, together with those users' seen items that fall in the
block. The task multiplies in numpy, masks the seen items and keeps the top
``n`` per user, so no (user, item) pair is ever a row and nothing passes
through the driver. Vectors are dense arrays (SVD) or sparse rows (exact
TF-IDF), read from Arrow's flat buffers. Inside a task bounds on tiles of items
spare products (T4, :mod:`cinelens.operators.blocks`). A final per-user
``row_number`` over the ``B * n`` candidates (planned with a partial
``WindowGroupLimit`` before the shuffle) gives the exact top ``n``.

Ties: ``round(similarity, 9)`` descending, then movieId ascending.

Block and salt counts come from ``count()`` of the item, user and seen tables
and the mean size of their vectors, a per-task memory budget (``budget_bytes``
for each of the three) and a floor of twice the session's parallelism in tasks.
A very active user's seen rows are spread over the item blocks, so no task
holds more than one block of them.

The grid copies every user to each block and every item to each salt, so with
both sides large the copies grow with the square of the input. They are made in
rounds of a few salts (:func:`salts_at_once`), each of which gives its users'
whole lists, and whose shuffle files go before the next one's are written.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.functions.vectors import is_sparse
from cinelens.operators import blocks
from cinelens.operators.joins import BROADCAST_LIMIT_BYTES, broadcast_if_small, vector_rows
from cinelens.session import ensure_checkpoint_dir, release, ship_package, stored

CANDIDATE_SCHEMA = "userId long, movieId long, similarity double"
# Session setting for the per-task vector budget, in MB per side.
BUDGET_CONF = "cinelens.scoring.budgetMB"
DEFAULT_BUDGET_MB = 64


def rank_order(sim_col: str = "similarity", id_col: str = "movieId"):
    """Ranking key shared by Spark and SQL oracles."""
    return [F.round(F.col(sim_col), 9).desc(), F.col(id_col).asc()]


def _kernel(n: int, dims: int, sparse: bool):
    def run(users, items):
        import pyarrow as pa

        kind = users.column("kind").to_numpy()
        prof, seen = (users.filter(pa.array(kind == k)) for k in (0, 1))
        user_ids, item_ids = prof.column("userId").to_numpy(), items.column("movieId").to_numpy()
        # A user's rows are one, but for callers that pass repeated users.
        places = pd.Index(user_ids).get_indexer_for(seen.column("userId").to_numpy()) if len(user_ids) else np.full(seen.num_rows, -1)
        columns = pd.Index(item_ids).get_indexer(seen.column("movieId").to_numpy()) if len(item_ids) else np.full(seen.num_rows, -1)
        known = (places >= 0) & (columns >= 0)
        read = blocks.Csr.from_arrow if sparse else lambda c: blocks.Dense.from_arrow(c, dims)
        rows, cols, sims, _ = blocks.top_unseen(read(prof.column("vec")), read(items.column("vec")), item_ids, places[known], columns[known], n)
        return pa.table({"userId": user_ids[rows], "movieId": item_ids[cols], "similarity": sims})

    return run


# Bytes of one seen row in a task (two ids, as columns and as lookups).
SEEN_ROW_BYTES = 64


def grid_size(
    n_users: int, n_items: int, dims: int, budget_bytes: int, min_tasks: int = 1, n_seen: int = 0,
    max_users: int | None = None, max_items: int | None = None, item_bytes: int | None = None, user_bytes: int | None = None,
):
    """(item blocks, user salts): a task holds at most ``budget_bytes`` of
    item vectors, as much of user vectors, and (with seen rows spread evenly)
    as much of seen rows; there are at least ``min_tasks`` tasks as long as
    there are users to split. ``max_users`` and ``max_items`` cut finer;
    ``item_bytes`` and ``user_bytes`` are the mean sizes of sparse rows."""
    per_row = max(dims, 1) * 8
    items_per_block = max(1, min(max_items or n_items or 1, budget_bytes // (item_bytes or per_row)))
    users_per_group = max(1, min(max_users or n_users or 1, budget_bytes // (user_bytes or per_row)))
    blocks = max(1, math.ceil(n_items / items_per_block))
    salts = max(1, math.ceil(n_users / users_per_group))
    salts = max(salts, min(max(n_users, 1), math.ceil(n_seen * SEEN_ROW_BYTES / (budget_bytes * blocks))))
    if blocks * salts < min_tasks:
        salts = max(salts, min(max(n_users, 1), math.ceil(min_tasks / blocks)))
    return blocks, salts


#: Copies of all vectors that lie in shuffle files at once.
COPIES = 3


def salts_at_once(n_blocks: int, salts: int, item_side: int, user_side: int, min_tasks: int = 1) -> int:
    """Salts of a round: their copies of the items (of ``item_side`` bytes) and
    of their users (``user_side`` bytes in all salts) are at most COPIES times
    both sides. A round has ``min_tasks`` tasks, or all."""
    each = item_side + user_side * n_blocks / salts
    most = COPIES * (item_side + user_side) / max(each, 1)
    return min(salts, max(1, int(most), math.ceil(min_tasks / n_blocks)))


def top_n_unseen(
    profiles: DataFrame,
    items: DataFrame,
    seen: DataFrame | None,
    n: int,
    dims: int,
    items_per_block: int | None = None,
    users_per_group: int | None = None,
    budget_bytes: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """Exact top ``n`` items per user, seen items excluded.

    ``profiles(userId, vec)``, ``items(movieId, vec)``, both dense (of
    ``dims`` components) or both sparse, ``seen(userId, movieId)`` (may be
    None). Returns ``(userId, movieId, similarity,
    rank)`` with ranks 1..n (fewer when fewer unseen items exist),
    checkpointed (at most ``n`` rows per user).
    """
    spark = profiles.sparkSession
    ship_package(spark)
    if budget_bytes is None:
        # Per-task vector budget (each side); larger executors can raise it
        # to cut the number of user salts, and so the catalogue copies.
        budget_bytes = int(float(spark.conf.get(BUDGET_CONF, str(DEFAULT_BUDGET_MB))) * (1 << 20))
    sparse = is_sparse(items)
    n_items, item_bytes = vector_rows(items, dims)
    n_users, user_bytes = vector_rows(profiles, dims)
    if seen is not None:
        # Only scored users' rows go to the grid. The scored ids are plain, so
        # beyond the broadcast limit AQE splits a very active user's rows.
        scored = profiles.select("userId")
        if n_users * 16 > BROADCAST_LIMIT_BYTES:
            ensure_checkpoint_dir(spark)
            scored = scored.checkpoint(eager=True)
        seen = seen.select("userId", "movieId").join(broadcast_if_small(scored, n_users, 16), "userId", "left_semi")
    min_tasks = 2 * spark.sparkContext.defaultParallelism
    n_blocks, salts = grid_size(
        n_users, n_items, dims, budget_bytes, min_tasks=min_tasks,
        n_seen=0 if seen is None else seen.count(), max_users=users_per_group, max_items=items_per_block,
        item_bytes=item_bytes, user_bytes=user_bytes,
    )
    kind = profiles.schema["vec"].dataType

    block_of = lambda c: F.pmod(F.xxhash64(F.lit(seed), F.col(c)), F.lit(n_blocks)).cast("int")
    salt_of = lambda c: F.pmod(F.xxhash64(F.lit(seed + 1), F.col(c)), F.lit(salts)).cast("int")

    def ranked(lo: int, hi: int) -> DataFrame:
        """Lists of the users of the salts from ``lo`` to ``hi``."""
        mine = salt_of("userId").between(lo, hi - 1)
        user_rows = profiles.filter(mine).select(
            F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
            salt_of("userId").alias("salt"),
            F.lit(0).alias("kind"),
            "userId",
            F.lit(None).cast("long").alias("movieId"),
            "vec",
        )
        if seen is not None:
            seen_rows = (
                seen
                .filter(mine)
                .select(
                    block_of("movieId").alias("block"),
                    salt_of("userId").alias("salt"),
                    F.lit(1).alias("kind"),
                    "userId",
                    "movieId",
                    F.lit(None).cast(kind).alias("vec"),
                )
            )
            user_rows = user_rows.unionByName(seen_rows)
        item_rows = items.select(
            block_of("movieId").alias("block"),
            F.explode(F.sequence(F.lit(lo), F.lit(hi - 1))).alias("salt"),
            "movieId",
            "vec",
        )
        cands = (
            user_rows.groupBy("block", "salt")
            .cogroup(item_rows.groupBy("block", "salt"))
            .applyInArrow(_kernel(int(n), dims, sparse), CANDIDATE_SCHEMA)
        )
        w = Window.partitionBy("userId").orderBy(*rank_order())
        return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)

    # Materialized once: callers read the lists several times (ranked rows,
    # list lengths, hits), and the kernel is the costliest step to redo.
    ensure_checkpoint_dir(spark)
    step = salts_at_once(n_blocks, salts, n_items * item_bytes, n_users * user_bytes, min_tasks)
    if step >= salts:
        return ranked(0, salts).checkpoint(eager=True)
    # Every round reads them: what made them is not done again.
    profiles, seen = stored(profiles.select("userId", "vec")), seen if seen is None else stored(seen)
    parts = [stored(ranked(lo, min(lo + step, salts))) for lo in range(0, salts, step)]
    top = reduce(DataFrame.unionByName, parts).checkpoint(eager=True)
    release(*parts, profiles, *([] if seen is None else [seen]))
    return top
