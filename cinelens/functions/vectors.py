"""Vector expressions (F8, A7-A9): dense ones on ``array<double>`` columns,
and sparse rows ``struct<idx: array<long>, val: array<double>>`` (``idx``
ascending), whose width is not bounded by memory.

``cosine`` is the column form of F8 (pairs already on one row); scoring
against a whole catalogue uses the blocked kernel in
``operators/scoring.py`` instead.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v
    )


def l2_norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; 0.0 when either side is a zero vector."""
    den = l2_norm(a) * l2_norm(b)
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(0.0))


def vec_mean(a, weight=None) -> Column:
    """Grouped (weighted) mean of equal-length arrays.

    Runs as Spark ML's Summarizer, a JVM aggregate with a partial
    (map-side) step, so a key holding a third of the rows is combined
    before the shuffle.
    """
    v = array_to_vector(_col(a))
    if weight is None:
        return vector_to_array(Summarizer.mean(v))
    return vector_to_array(Summarizer.mean(v, _col(weight)))


def vec_sum(a) -> Column:
    """Grouped element-wise sum of equal-length arrays (partial aggregation)."""
    return vector_to_array(Summarizer.sum(array_to_vector(_col(a))))


def weighted_sum(vector, weight) -> Column:
    """Grouped ``sum(weight * vector)`` of an ML vector column; weights are
    positive."""
    return vector_to_array(Summarizer.sum(_col(vector), _col(weight)))


def is_sparse(df: DataFrame, col: str = "vec") -> bool:
    return isinstance(df.schema[col].dataType, T.StructType)


def entries(col: str = "vec") -> Column:
    """Array of structs ``(idx, val)`` of a sparse row."""
    return F.arrays_zip(F.col(f"{col}.idx").alias("idx"), F.col(f"{col}.val").alias("val"))


def sparse(pairs) -> Column:
    """Sparse row from an array of structs ``(idx, val)``, in any order."""
    ordered = F.array_sort(_col(pairs))
    return F.struct(F.transform(ordered, lambda e: e["idx"]).alias("idx"), F.transform(ordered, lambda e: e["val"]).alias("val"))
