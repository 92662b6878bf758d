"""Centroid clustering of integer vectors by a bisector tournament.

Components x become ``floor(scale * x)``; all that follows is integer and
exact.

*Bisectors.* For centroids a and b (a before b), ``|v - a|^2 - |v - b|^2`` is
``2 v.(b - a) - (|b|^2 - |a|^2)``: the sign of a linear form with an integer
normal and threshold, both made once a round for every pair. A vector's winner
is found in k - 1 sign tests: the winner so far meets the next centroid, and a
positive sign throws it out. Zero is a tie and favours the smaller number.
Nearness is a total preorder, so the last winner is the nearest centroid. Its
distance alone is computed, exactly.

*Rounds.* A task assigns its vectors block by block and sends one row for each
cluster, component and digit: sums of digits, which Spark adds up. The driver
gets ``k * (dims + 1)`` rows and takes ``floor(sum / count)``; an empty cluster
keeps its centroid. A large cluster moves as one partial sum for each task.

*Range.* While all components of a block and of the centroids are small enough
(2**27 for 64 components), forms and distances fit 64 bits; other blocks are
computed with Python's integers, with the same results. Sums go as digits to the base 2**64.
A distance or sum beyond 64 bits is null.

Only vectors of exactly ``dims`` components take part, none of them null or
non-finite (after scaling too), with an id. Rows that repeat an id are vectors
of their own. With fewer vectors than ``k`` there are as many centroids; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import prepare
from cinelens.session import release, stored


@dataclass(frozen=True)
class Params:
    dims: int = 64
    scale: int = 256
    k: int = 40
    rounds: int = 5
    seed: int = 2

    @property
    def narrow(self) -> int:
        """Largest magnitude whose forms and distances fit 64 bits."""
        return math.isqrt((1 << 62) // (4 * max(self.dims, 1)))


#: Vectors handled together in a task.
BLOCK_ROWS = 2048
#: Bytes of normals made beforehand; with more centroids each test makes its own.
PAIR_BYTES = 64 << 20
DIGIT = 64


def clean(vectors: DataFrame, params: Params) -> DataFrame:
    """``vec_id, v (array<double> of whole numbers)`` of rows that take part."""
    scaled = F.transform("embedding", lambda x: F.lit(float(params.scale)) * x.cast("double"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") == params.dims) & F.forall("v", fine))
    # Beyond 2**53 a double is whole already, and may be too large for a long.
    return rows.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < F.lit(float(1 << 53)), F.floor(x).cast("double")).otherwise(x)))


def integers(block: np.ndarray, narrow: int) -> np.ndarray:
    """Whole doubles as 64-bit integers where their forms fit, else as Python's."""
    if not block.size or np.abs(block).max() <= narrow:
        return block.astype(np.int64)
    return np.array([int(x) for x in block.ravel().tolist()], object).reshape(block.shape)


def vectors_of(batch, params: Params):
    """(ids, integer vectors) of an Arrow batch, in blocks."""
    for at in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(at, BLOCK_ROWS)
        yield part.column("vec_id"), integers(part.column("v").flatten().to_numpy().reshape(-1, params.dims), params.narrow)


class Bisectors:
    """Normals and thresholds of all centroid pairs."""

    def __init__(self, centroids: list[list[int]], params: Params):
        narrow = all(abs(x) <= params.narrow for c in centroids for x in c)
        self.exact = np.array(centroids, object)
        self.c = np.array(centroids, np.int64) if narrow else self.exact
        self.narrow, self.norms = narrow, (self.c * self.c).sum(axis=1)
        k, dims = self.c.shape
        self.pairs = None
        if k * k * dims * 8 <= PAIR_BYTES:
            # Of each pair (a, b): 2 (b - a) and |b|^2 - |a|^2.
            self.pairs = 2 * (self.c[None, :, :] - self.c[:, None, :]), self.norms[None, :] - self.norms[:, None]

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each vector."""
        c, norms, pairs = self.c, self.norms, self.pairs
        if v.dtype == object and self.narrow:
            c, norms, pairs = self.exact, (self.exact * self.exact).sum(axis=1), None
        winner = np.zeros(len(v), np.int64)
        for b in range(1, len(c)):
            if pairs:
                normal, threshold = pairs[0][:, b][winner], pairs[1][:, b][winner]
            else:
                normal, threshold = 2 * (c[b] - c[winner]), norms[b] - norms[winner]
            form = np.einsum("ij,ij->i", v, normal) if normal.dtype == v.dtype == np.int64 else (v * normal).sum(axis=1)
            winner[(form - threshold) > 0] = b
        gap = v - c[winner]
        return winner, (gap * gap).sum(axis=1)


def digits(value: int):
    """(place, digit) of an integer to the base 2**64, the sign on each."""
    sign, rest, at = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        low = rest & (1 << DIGIT) - 1
        if low:
            yield at, sign * low
        rest, at = rest >> DIGIT, at + 1


def partial_sums(shared, params: Params):
    """Task over vectors: rows of each cluster (component -1: its vectors)."""

    def run(batches):
        from decimal import Decimal

        import pyarrow as pa

        bisectors = shared.value
        k = len(bisectors.exact)
        counts, sums = np.zeros(k, np.int64), [[0] * params.dims for _ in range(k)]
        for batch in batches:
            for _, v in vectors_of(batch, params):
                winner, _ = bisectors.nearest(v)
                for c in np.unique(winner).tolist():
                    mine = v[winner == c]
                    counts[c] += len(mine)
                    sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(axis=0))]
        rows = [(c, -1, 0, int(counts[c])) for c in range(k) if counts[c]]
        rows += [(c, i, at, d) for c in range(k) for i, total in enumerate(sums[c]) for at, d in digits(total)]
        cluster, component, at, part = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int64()), pa.array(component, pa.int64()), pa.array(at, pa.int64()), pa.array(map(Decimal, part), pa.decimal128(38, 0))],
                                         names=["cluster", "component", "at", "part"])

    return run


def moved(rows: DataFrame, centroids: list[list[int]], params: Params) -> list[list[int]]:
    """The centroids after a round."""
    shared = rows.sparkSession.sparkContext.broadcast(Bisectors(centroids, params))
    parts = rows.mapInArrow(partial_sums(shared, params), "cluster long, component long, at long, part decimal(38,0)")
    count, sums = {}, [[0] * params.dims for _ in centroids]
    for c, i, at, part in parts.groupBy("cluster", "component", "at").agg(F.sum("part").cast("decimal(38,0)").alias("part")).collect():
        if i < 0:
            count[c] = int(part)
        else:
            sums[c][i] += int(part) << DIGIT * at
    shared.unpersist()
    return [[s // count[c] for s in sums[c]] if c in count else old for c, old in enumerate(centroids)]


def assigned(rows: DataFrame, centroids: list[list[int]], params: Params) -> DataFrame:
    """``vec_id, cluster, distance``."""
    shared = rows.sparkSession.sparkContext.broadcast(Bisectors(centroids, params))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for ids, v in vectors_of(batch, params):
                winner, distance = shared.value.nearest(v)
                fits = [int(d) if d < 1 << 63 else None for d in distance.tolist()] if v.dtype == object or distance.dtype == object else distance
                yield pa.RecordBatch.from_arrays([ids, pa.array(winner, pa.int32()), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256`` of each row of ``vectors(vec_id, embedding)`` that takes
    part. Centroids start as the ``k`` vectors with the smallest SHA-256 of
    ``seed:vec_id``; of rows that share an id the smaller vector comes first.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(clean(vectors, params))
    ticket = F.sha2(F.concat(F.lit(f"{params.seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [[int(x) for x in r["v"]] for r in rows.orderBy(ticket, "v").limit(params.k).collect()]
    if not centroids:
        none = [F.lit(None).cast(t).alias(n) for n, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]
        return rows.select("vec_id", *none)
    for _ in range(params.rounds):
        centroids = moved(rows, centroids, params)
    found = stored(assigned(rows, centroids, params))
    release(rows)
    wide = lambda c: F.when(F.count(F.lit(1)) == F.count(c), F.sum(F.col(c).cast("decimal(38,0)")))
    each = found.groupBy("cluster").agg(wide("distance").alias("total"))
    totals = each.collect()  # one row for each centroid
    whole = None if any(r["total"] is None for r in totals) else sum(int(r["total"]) for r in totals)
    fits = lambda x: None if x is None or int(x) >= 1 << 63 else int(x)
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    facts = spark.createDataFrame([(r["cluster"], fits(r["total"]), fits(whole), digest(r["cluster"])) for r in totals],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
