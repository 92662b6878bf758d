"""Exact order statistics of many columns, by repeated histogram refinement.

Every wanted rank has an interval that holds it, at first the column's range.
A pass counts, for all intervals of all columns at once, the values in each of
``BINS`` equal parts, with the least and greatest value there. The part that
holds the rank becomes its interval, cut to the values found, until it holds
one value. The least and greatest value of an interval lie in different parts,
so every pass narrows it, by ``BINS`` where values are spread. So the number of
passes depends on the values and not on the number of columns or rows; nothing
is sorted, and a pass sends at most ``BINS`` counts for each interval and task.

Nulls take no part. Infinite values and NaN (greatest, as Spark orders it) are
counted beforehand, as ends of the range.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 512
INFINITY = float("inf")


def facts(x: Column) -> Column:
    """What :func:`order_statistics` has to know of a column, as an array
    aggregate: values below, inside and above the finite range, NaNs, and that
    range's ends."""
    finite = F.when(~F.isnan(x) & (F.abs(x) != F.lit(INFINITY)), x)
    count = lambda test: F.count_if(test).cast("double")
    return F.array(count(x == F.lit(-INFINITY)), F.count(finite).cast("double"), count(x == F.lit(INFINITY)), count(F.isnan(x)),
                   F.min(finite), F.max(finite))


def order_statistics(df: DataFrame, wanted: dict[str, set[int]], known: dict[str, list[float]]) -> dict[tuple[str, int], float]:
    """The values at 0-based ``wanted`` ranks of each column's sorted non-null
    values (as doubles); ``known`` holds each column's :func:`facts`."""
    out: dict[tuple[str, int], float] = {}
    todo: dict[tuple[str, int], tuple[float, float, int]] = {}  # (low, high, values below)
    for column, ranks in wanted.items():
        below, inside, above, _, low, high = known[column]
        for rank in ranks:
            if rank < below:
                out[column, rank] = -INFINITY
            elif rank < below + inside:
                todo[column, rank] = low, high, int(below)
            else:
                out[column, rank] = INFINITY if rank < below + inside + above else math.nan
    while todo:
        for key in [k for k, (low, high, _) in todo.items() if low == high]:
            out[key] = todo.pop(key)[0]
        if not todo:
            break
        places = list(dict.fromkeys((c, low, high) for (c, _), (low, high, _) in todo.items()))
        parts = _counted(df, places)
        for (column, rank), (low, high, below) in list(todo.items()):
            rows = parts[places.index((column, low, high))]
            ends = list(accumulate(r[0] for r in rows))
            at = next(i for i, end in enumerate(ends) if below + end > rank)
            n, least, most = rows[at]
            todo[column, rank] = least, most, below + ends[at] - n
    return out


def _counted(df: DataFrame, places: list[tuple[str, float, float]]) -> list[list[tuple[int, float, float]]]:
    """(values, least, greatest) of the parts of each interval, in order. One
    pass; a few rows for each interval reach the driver."""
    columns = list(dict.fromkeys(c for c, _, _ in places))
    values = F.array(*(F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(columns)))
    intervals = df.sparkSession.createDataFrame(
        [(i, columns.index(c), low, high) for i, (c, low, high) in enumerate(places)], "place int, c int, low double, high double")
    x, low, high = F.col("x"), F.col("low"), F.col("high")
    whole = (x - low) / (high - low)
    halves = (x / 2 - low / 2) / (high / 2 - low / 2)  # where the range itself overflows
    share = F.when(high - low < F.lit(INFINITY), whole).otherwise(halves)
    part = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
    held = df.select(F.explode(values).alias("v")).select("v.c", "v.x").filter(x.isNotNull() & ~F.isnan(x))
    inside = held.join(F.broadcast(intervals), "c").filter(x.between(low, high))
    counts = inside.groupBy("place", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
    out: list[list] = [[] for _ in places]
    for r in sorted(counts.collect()):
        out[r["place"]].append((r["n"], r["least"], r["most"]))
    return out
