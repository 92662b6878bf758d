"""Join helper: broadcast only behind a size check.

Checkpointed and Python-produced tables carry no size statistics, so
neither the planner nor AQE can choose a broadcast for them. Callers that
know a row count (a ``count()`` they already need) use this instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.functions.vectors import is_sparse

# Largest side broadcast on a checked size (vectors, metadata).
BROADCAST_LIMIT_BYTES = 64 << 20
# Largest id set broadcast into a semi join (about 10 million ids).
ID_SET_LIMIT_BYTES = 256 << 20
ID_ROW_BYTES = 24
# Conservative size of a (term, number) row when broadcast.
TERM_ROW_BYTES = 96


def broadcast_if_small(df: DataFrame, rows: int, bytes_per_row: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``rows * bytes_per_row <= limit``, else
    ``df`` unchanged (a shuffle join, split by AQE when skewed)."""
    return F.broadcast(df) if rows * max(bytes_per_row, 1) <= limit else df


def vector_rows(df: DataFrame, dims: int) -> tuple[int, int]:
    """(rows, mean bytes of a row) of a table with a vector ``vec``."""
    if not is_sparse(df):
        return df.count(), vector_row_bytes(dims)
    rows, held = df.agg(F.count(F.lit(1)), F.sum(F.size("vec.val"))).first()
    return rows, 16 * (held or 0) // max(rows, 1) + 64


def vector_row_bytes(dims: int) -> int:
    """Rough size of an ``(id, array<double>[dims])`` row."""
    return 8 * max(dims, 1) + 32
