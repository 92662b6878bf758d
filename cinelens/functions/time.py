"""Time expressions that do not depend on the session time zone.

Naive (``timestamp_ntz``) values are wall-clock times in UTC; converting
through the zoned ``timestamp`` type would shift them by the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_from_epoch_seconds(c) -> Column:
    """Epoch seconds -> naive timestamp (UTC wall clock)."""
    return F.timestamp_add("SECOND", _col(c).cast("bigint"), _epoch())


def epoch_seconds(c) -> Column:
    """Naive timestamp -> epoch seconds (the inverse of the above)."""
    return F.timestamp_diff("SECOND", _epoch(), _col(c).cast("timestamp_ntz"))
