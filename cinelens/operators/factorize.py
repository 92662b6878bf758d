"""Item vectors from the TF-IDF table: exact (F6 rows) or truncated SVD.

The SVD is a randomized subspace iteration (Halko, Martinsson & Tropp,
"Finding structure with randomness", SIAM Review 2011, algorithm 4.4), the
method family the reference's solver uses. Both large dimensions stay in
DataFrames:

- ``A`` is the long table ``(movieId, term, weight)``;
- the random test matrix ``Omega`` is a function of the term text (a seeded
  hash), so it is never stored or shipped;
- ``A @ X`` and ``A.T @ X`` are a join of ``A`` with a per-term or
  per-movie vector table and a grouped vector sum (partial aggregation);
- only ``l x l`` matrices (``l = k + oversampling``) reach the driver: the
  triangles of tall QR factorizations, for orthonormalization and for the
  small SVD of ``B``.

Item vectors are ``A V_k = U_k S_k`` (uncentred, like the reference). The
result may be a rotation or sign flip of another solver's, which leaves
every cosine unchanged.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.functions.vectors import sparse, vec_sum, weighted_sum
from cinelens.operators.joins import TERM_ROW_BYTES, broadcast_if_small
from cinelens.operators.ordering import numbered
from cinelens.session import ensure_checkpoint_dir, ship_package

# ------------------------------------------------------------ exact vectors


def exact_vectors(weights: DataFrame, vocab: DataFrame, movies: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Sparse TF-IDF rows over the vocabulary in term order: ``(movieId,
    vec)``, the vocabulary with each term's position ``idx``, and its size.

    Positions come from a range partitioning, so a vocabulary of any size has
    them without a single task. Movies with no kept term get an empty row.
    """
    dims = vocab.count()
    if dims == 0:
        raise ValueError("No term is left in the vocabulary: lower min_df or raise max_df.")
    placed = numbered(vocab, "term", name="idx").checkpoint(eager=True)
    index = broadcast_if_small(placed.select("term", "idx"), dims, TERM_ROW_BYTES)
    held = weights.join(index, "term").filter(F.col("weight") != 0).groupBy("movieId").agg(
        sparse(F.collect_list(F.struct("idx", F.col("weight").alias("val")))).alias("vec")
    )
    none = F.struct(F.array().cast("array<bigint>").alias("idx"), F.array().cast("array<double>").alias("val"))
    items = movies.select("movieId").join(held, "movieId", "left").select("movieId", F.coalesce("vec", none).alias("vec"))
    return items, placed, dims


def attach_zero_rows(movies: DataFrame, vecs: DataFrame, dims: int) -> DataFrame:
    """Every catalogue movie with its vector; missing ones get zeros."""
    zeros = F.array_repeat(F.lit(0.0), dims)
    return (
        movies.select("movieId")
        .join(vecs, "movieId", "left")
        .select("movieId", F.coalesce(F.col("vec"), zeros).alias("vec"))
    )


# ------------------------------------------------------- small dense algebra


def _rows(column, width: int) -> np.ndarray:
    """A list column of an Arrow batch as a matrix, from its flat buffer."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


# Largest Gram matrix (2,896 columns) held by a task and by the driver.
GRAM_LIMIT_BYTES = 64 << 20
# Largest triangle (8,192 columns) held by a task and by the driver.
TRIANGLE_LIMIT_BYTES = 512 << 20
# Triangles stacked and factorized together by one task of the tree.
FAN_IN = 16


def gram(df: DataFrame, col: str, width: int) -> np.ndarray:
    """``X^T X`` of a vector column (``width x width``, on the driver).

    Each task adds its rows' products in numpy; the partials are summed by one
    grouped vector sum. Only ``width^2`` numbers are returned.
    """

    if width * width * 8 > GRAM_LIMIT_BYTES:
        raise ValueError(f"{width} columns: their Gram matrix is over {GRAM_LIMIT_BYTES >> 20} MB; ask for fewer components")

    def partial(batches):
        import pyarrow as pa

        acc = np.zeros((width, width))
        for batch in batches:
            x = _rows(batch.column(0), width)
            acc += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([acc.ravel()], pa.list_(pa.float64()))], names=["g"])

    ship_package(df.sparkSession)
    parts = df.select(col).mapInArrow(partial, "g array<double>")
    row = parts.agg(vec_sum("g").alias("g")).first()
    if row is None or row["g"] is None:
        return np.zeros((width, width))
    return np.asarray(row["g"], dtype=np.float64).reshape(width, width)


def triangle(df: DataFrame, col: str, width: int) -> np.ndarray:
    """R of ``X = Q R`` for the tall matrix of a vector column, by a tree of
    QR factorizations (TSQR; Demmel, Grigori, Hoemmen & Langou 2012).

    Each task factorizes its rows block by block and keeps the triangle alone;
    tasks of the next level stack ``FAN_IN`` triangles and factorize again,
    until one is left. ``R^T R`` is the Gram matrix, but R comes from the rows
    themselves, so small directions keep their digits: a Gram matrix squares
    the condition and loses those under 1e-8.
    """
    if width * width * 8 > TRIANGLE_LIMIT_BYTES:
        raise ValueError(f"{width} columns: their triangle is over {TRIANGLE_LIMIT_BYTES >> 20} MB; ask for fewer components")
    kind = "part long, r array<double>"

    def row(part: int, r: np.ndarray):
        import pyarrow as pa

        return [pa.array([part] if len(r) else [], pa.int64()), pa.array([r.ravel()] if len(r) else [], pa.list_(pa.float64()))]

    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        r, step = np.zeros((0, width)), max(width, 1024)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                r = np.linalg.qr(np.vstack([r, _rows(batch.slice(at, step).column(0), width)]), mode="r")
        yield pa.RecordBatch.from_arrays(row(TaskContext.get().partitionId(), r), names=["part", "r"])

    def merge(table):
        import pyarrow as pa

        blocks = [np.asarray(x).reshape(-1, width) for x in table.column("r").to_numpy()]
        return pa.Table.from_arrays(row(table.column("part")[0].as_py() // FAN_IN, np.linalg.qr(np.vstack(blocks), mode="r")), names=["part", "r"])

    ship_package(df.sparkSession)
    parts, left = df.select(col).mapInArrow(partial, kind), df.rdd.getNumPartitions()
    while True:
        parts, left = parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(merge, kind), -(-left // FAN_IN)
        if left <= 1:
            break
    found = [np.asarray(x["r"]).reshape(-1, width) for x in parts.collect()]  # one row
    return np.linalg.qr(np.vstack(found), mode="r") if found else np.zeros((0, width))


def apply_matrix(df: DataFrame, key: str, col: str, m: np.ndarray) -> DataFrame:
    """``(key, col @ m)`` for a small matrix ``m`` shipped with the task."""
    width_in, width_out = m.shape
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            y = _rows(batch.column(1), width_in) @ m
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * width_out)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], names=[key, col])

    ship_package(df.sparkSession)
    return df.select(key, col).mapInArrow(run, f"{key} {key_type}, {col} array<double>")


def orthonormal_transform(r: np.ndarray) -> np.ndarray:
    """``M`` with orthonormal columns ``X M`` that span X, from its triangle;
    directions of relative size ``ZERO`` or less are rounding and go."""
    _, s, vt = np.linalg.svd(r, full_matrices=False)
    keep = s > ZERO * s.max() if s.size and s.max() > 0 else np.zeros(s.shape, bool)
    return vt[keep].T / s[keep]


# Relative size of a direction that counts as zero at working precision.
ZERO = 1e-13


# ---------------------------------------------------------------- the SVD


def _omega(term_col, width: int, seed: int):
    """Row of the Gaussian test matrix for a term (Box-Muller on hashes)."""

    def normal(j):
        u1 = (F.pmod(F.xxhash64(F.lit(seed), term_col, j, F.lit(1)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(
            float(1 << 52)
        )
        u2 = (F.pmod(F.xxhash64(F.lit(seed), term_col, j, F.lit(2)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(
            float(1 << 52)
        )
        return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * np.pi) * u2)

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), normal)


# Largest factor (rows x width doubles) joined to A by broadcast.
BROADCAST_FACTOR_BYTES = 64 << 20


class _Sides:
    """A, held once, dealt by (movieId, term) so that neither a very common
    term nor a very long text fills a partition.

    A product joins A with a factor keyed by one side and sums by the other.
    A factor under the size limit is broadcast, and A does not move; a larger
    one is joined by a shuffle of two plain tables, which AQE splits where a
    key is skewed. Either way the sum begins before its own shuffle (partial
    aggregation), so a common key moves as one partial sum for each task.
    """

    def __init__(self, a: DataFrame, n_docs: int, n_terms: int, positive: bool = False):
        from pyspark import StorageLevel

        self.positive = positive  # all weights are, and finite

        self.a = a.repartition("movieId", "term").persist(StorageLevel.MEMORY_AND_DISK)
        self.rows = {"movieId": n_docs, "term": n_terms}

    def times(self, x: DataFrame, on: str, group: str, width: int) -> DataFrame:
        """``sum over `on` of weight * x[on]`` grouped by ``group``:
        ``A @ X`` when ``on='term'``, ``A^T @ X`` when ``on='movieId'``.
        Checkpointed: it is read twice (triangle, next product) and its lineage
        holds every earlier iteration."""
        small = self.rows[on] * max(width, 1) * 8 <= BROADCAST_FACTOR_BYTES
        if self.positive:
            # A factor's row is made a vector once, not once an entry of A.
            x, scaled = x.select(on, array_to_vector("vec").alias("vec")), weighted_sum("vec", "weight")
        else:
            scaled = vec_sum(F.transform("vec", lambda v: v * F.col("weight")))
        joined = self.a.join(F.broadcast(x) if small else x, on)
        prod = joined.groupBy(group).agg(scaled.alias("vec"))
        return prod.checkpoint(eager=True)

    def release(self) -> None:
        self.a.unpersist()


def _normalized(df: DataFrame, key: str, width: int) -> tuple[DataFrame, int]:
    """Orthonormal columns spanning ``df.vec``, by one triangle and a lazy
    transform: the iterate is not written, it feeds the next product."""
    m = orthonormal_transform(triangle(df, "vec", width))
    if m.shape[1] == 0:
        return df, 0
    return apply_matrix(df, key, "vec", m), m.shape[1]


def _orthonormalize(df: DataFrame, key: str, width: int) -> tuple[DataFrame, int]:
    """As :func:`_normalized`, twice: dividing by a triangle of condition c
    leaves columns orthonormal to c times the rounding, and the second triangle
    is that of nearly orthonormal columns."""
    for _ in range(2):
        df, width = _normalized(df, key, width)
        if width == 0:
            break
        df = df.checkpoint(eager=True)
    return df, width


def randomized_svd(
    weights: DataFrame,
    movies: DataFrame,
    n_components: int,
    seed: int = 42,
    oversample: int = 10,
    power_iters: int = 5,
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """``(items[movieId, vec], term_basis[term, vec], singular_values)``.

    ``items`` rows are ``U_k S_k`` (length ``n_components``, zero-padded
    when the matrix rank is lower: Q17); ``term_basis`` rows are ``V_k`` and
    project a new TF-IDF row as ``sum(weight * basis[term])``. Raises when
    ``n_components`` exceeds the number of terms.

    Per power iteration: two products with ``A`` (one join + grouped sum
    each, checkpointed) and two triangles; the final basis gets two more.
    """
    spark = weights.sparkSession
    ensure_checkpoint_dir(spark)
    k = int(n_components)
    a = weights.select("movieId", "term", "weight").checkpoint(eager=True)
    n_terms = a.select("term").distinct().count()
    n_docs = a.select("movieId").distinct().count()
    if n_terms == 0:
        raise ValueError("No term is left in the vocabulary: lower min_df or raise max_df.")
    if k > n_terms:
        raise ValueError(f"n_components={k} is above the number of terms ({n_terms})")
    width = k + max(int(oversample), 0)
    sides = _Sides(a, n_docs, n_terms, a.filter((F.col("weight") > 0) & (F.col("weight") < float("inf"))).count() == a.count())

    # Range finder: Y = A Omega, then Y <- A orth(A^T orth(Y)).
    y = sides.a.groupBy("movieId").agg(
        vec_sum(F.transform(_omega(F.col("term"), width, seed), lambda v: v * F.col("weight"))).alias("vec")
    ).checkpoint(eager=True)
    for _ in range(int(power_iters)):
        q, width = _normalized(y, "movieId", width)
        if width == 0:
            break
        z, width = _normalized(sides.times(q, "movieId", "term", width), "term", width)
        if width == 0:
            break
        y = sides.times(z, "term", "movieId", width)
    q, width = _orthonormalize(y, "movieId", width) if width else (y, 0)

    if width == 0:  # all-zero matrix
        sides.release()
        zeros = F.array_repeat(F.lit(0.0), k)
        items = movies.select("movieId", zeros.alias("vec"))
        basis = a.select("term").distinct().select("term", zeros.alias("vec"))
        return items, basis, np.zeros(k)

    # B = Q^T A as per-term columns b(t), the rows of B^T = Q' R; the left
    # singular vectors of B are the right ones of R.
    b = sides.times(q, "movieId", "term", width)
    sides.release()
    _, s, vt = np.linalg.svd(triangle(b, "vec", width), full_matrices=False)
    u_b = vt.T
    r = min(k, len(s))
    s_k = np.where(s[:r] > ZERO * s[0], s[:r], 0.0)

    # Items: Q U_B[:, :k] S_k, padded with zero columns up to k.
    to_items = np.zeros((width, k))
    to_items[:, :r] = u_b[:, :r] * s_k
    items = attach_zero_rows(movies, apply_matrix(q, "movieId", "vec", to_items), k)

    # Terms: V_k = B^T U_B S^-1 (columns with s = 0 stay zero).
    inv = np.where(s_k > 0, 1.0 / np.where(s_k > 0, s_k, 1.0), 0.0)
    to_terms = np.zeros((width, k))
    to_terms[:, :r] = u_b[:, :r] * inv
    basis = apply_matrix(b, "term", "vec", to_terms)
    values = np.zeros(k)
    values[:r] = s_k
    return items, basis, values
