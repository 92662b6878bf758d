"""Exact top-k by inner product: Fagin's threshold algorithm.

Vectors are whole numbers, ``floor(scale * x)`` with x as double. Within a
shard every dimension has a list of the rows sorted by that component. A
query reads all lists in step, from the end that suits the sign of its own
component: the rows met are scored in full, and at each depth the threshold
(the sum over dimensions of the query's component times the list's value
there) bounds every row not met yet. Reading stops when the k-th score found
is above the threshold, so that no row unseen could reach it or tie, or when
every row has been met. Depths grow geometrically, and the rows new at a depth
are scored together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelens.llm import vectors

K = 20
SCALE = 64
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
#: First depth of the lists; each next one is twice as deep.
FIRST_DEPTH = 16


class Lists:
    def __init__(self, rows: np.ndarray):
        self.rows = rows
        # order[i, d]: the row with the i-th largest component d (ties by place).
        self.order = np.argsort(-rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)
        self.n, self.dims = rows.shape

    def top(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the k best rows whose id is not ``own``, best
        first and ties by id, and the depth read. Lists of components 0 add
        nothing to a score and are not read."""
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        query = np.array([int(x) for x in query.tolist()], object) if self.rows.dtype == object else query.astype(self.rows.dtype)
        met, scores = np.zeros(self.n, bool), np.zeros(self.n, self.rows.dtype)
        depth, best = 0, np.empty(0, np.int64)
        while True:
            last, depth = depth, min(self.n, max(FIRST_DEPTH, depth * 2))
            fresh = np.zeros(self.n, bool)
            fresh[self.order[last:depth][:, up]] = True
            fresh[self.order[self.n - depth : self.n - last][:, down]] = True
            if not len(up) and not len(down):
                fresh[:] = True
            fresh &= ~met
            new = np.flatnonzero(fresh)
            met |= fresh
            scores[new] = self.rows[new] @ query
            best = np.concatenate([best, new[ids[new] != own]])
            if len(best) > 4 * k:
                found = scores[best]
                best = best[found >= (np.sort(found) if found.dtype == object else np.partition(found, -k))[-k]]
            best = best[_order(scores[best], ids[best])][:k]
            if met.all() or depth == self.n:
                return best, scores[best], depth
            bound = (self.sorted[depth - 1, up] * query[up]).sum() + (self.sorted[self.n - depth, down] * query[down]).sum()
            if len(best) == k and scores[best[-1]] > bound:
                return best, scores[best], depth


def _order(scores: np.ndarray, ids: np.ndarray):
    """Places by falling score, ties by id."""
    if scores.dtype != object:
        return np.lexsort((ids, -scores))
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), np.int64)


def exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """``rows`` in a type that holds every partial sum of a product exactly:
    floats while they do, else Python's integers."""
    largest = np.abs(rows).max() * np.abs(queries).max() * rows.shape[1]
    if largest < 2.0**53:
        return rows.astype(np.float32 if largest < 2.0**24 else np.float64)
    return np.array([int(x) for x in rows.ravel().tolist()], object).reshape(rows.shape)


def quantize(vec: str = "vec", scale: int = SCALE) -> Column:
    """Whole numbers as doubles (beyond 2**53 a double is whole already)."""
    scaled = F.transform(vec, lambda x: x * F.lit(float(scale)))
    return F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(float(1 << 53)), F.floor(x).cast("double")).otherwise(x))


def search(embeddings: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for every row of
    ``embeddings(vec_id, embedding)`` that ``is_query``.

    Rows with a null id, a null or empty vector, or a component that is null
    or not finite (also once scaled) take no part; only vectors of one length
    are compared. Products too large for a double are made with Python's
    integers, exactly; scores that a long can't hold are null, and ranked by id
    among themselves.
    """
    rows = vectors.clean(embeddings).withColumn("vec", quantize(scale=scale))
    rows = rows.filter(F.forall("vec", lambda x: F.abs(x) != F.lit(float("inf"))))

    def within(ids, rows, asked, queries):
        lists = Lists(exact(rows, queries))
        got = [lists.top(q, ids, own, k)[:2] for own, q in zip(asked, queries)]
        at = np.repeat(np.arange(len(got)), [len(b) for b, _ in got])
        scores = np.concatenate([s for _, s in got])
        return at, ids[np.concatenate([b for b, _ in got])], scores.astype(np.int64) if scores.dtype != object else scores

    return vectors.search(rows, is_query, within, k, F.desc, shard_rows, block_rows, "int64")
