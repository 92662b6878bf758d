"""User profiles (R1, A7, A8) and the catalogue centroid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.functions.vectors import entries, is_sparse, vec_mean, vec_sum
from cinelens.operators.joins import broadcast_if_small, vector_rows


def liked(ratings: DataFrame, threshold: float) -> DataFrame:
    """``rating >= threshold`` (inclusive)."""
    return ratings.filter(F.col("rating") >= F.lit(float(threshold)))


def weighted_profiles(rows: DataFrame, weight_col: str = "rating", count_col: str | None = None) -> DataFrame:
    """Per user ``sum(w * v) / sum(w)``; the plain mean when the
    weights sum to zero (Q20). Input ``(userId, vec, <weight_col>)``;
    ``count_col`` (optional) gives each row's multiplicity for the mean.

    Grouped JVM aggregates with a map-side step (Spark ML's Summarizer for
    vector sums), so a user with a third of all rows is combined before
    the shuffle. Sparse rows are summed by (user, term) first, likewise.
    """
    w = F.col(weight_col)
    if is_sparse(rows):
        return _sparse_profiles(rows, w, F.col(count_col) if count_col else F.lit(1.0))
    mean = vec_mean("vec", count_col) if count_col else vec_mean("vec")
    agg = rows.groupBy("userId").agg(
        vec_sum(F.transform("vec", lambda x: x * w)).alias("_wvec"),
        F.sum(w).alias("_wsum"),
        mean.alias("_mean"),
    )
    wsum = F.col("_wsum")
    return agg.select(
        "userId",
        F.when(F.abs(wsum) <= F.lit(1e-8), F.col("_mean"))
        .otherwise(F.transform("_wvec", lambda x: x / wsum))
        .alias("vec"),
    )


def _sparse_profiles(rows: DataFrame, weight, count) -> DataFrame:
    """Sums by (user, index); the index -1 carries the sums of the weights,
    so that a user whose rows are all empty has a (zero) profile too."""
    total = F.array(F.struct(F.lit(-1).cast("long").alias("idx"), F.lit(1.0).alias("val")))
    each = rows.select("userId", weight.alias("w"), count.alias("n"), F.explode(F.concat(total, entries("vec"))).alias("e"))
    sums = each.groupBy("userId", F.col("e.idx").alias("idx")).agg(
        F.sum(F.col("w") * F.col("e.val")).alias("w"), F.sum(F.col("n") * F.col("e.val")).alias("n"))
    held = sums.groupBy("userId").agg(F.array_sort(F.collect_list(F.struct("idx", "w", "n"))).alias("all"))
    first, rest = F.col("all")[0], F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(1)))
    value = lambda e: F.when(F.abs(first["w"]) <= F.lit(1e-8), e["n"] / first["n"]).otherwise(e["w"] / first["w"])
    return held.select("userId", F.struct(F.transform(rest, lambda e: e["idx"]).alias("idx"), F.transform(rest, value).alias("val")).alias("vec"))


def build_profiles(
    ratings: DataFrame, items: DataFrame, threshold: float, n_items: int | None = None, dims: int | None = None
) -> DataFrame:
    """Liked ratings joined to item vectors (J3 as an inner join, P4),
    weighted by the rating. Users with no liked, known movie get no row.
    A movie rated twice by a user counts twice (Q14). With ``n_items`` and
    ``dims`` known, a small item table is broadcast (checked size)."""
    if n_items is not None and dims is not None:
        items = broadcast_if_small(items, *vector_rows(items, dims))
    rows = liked(ratings, threshold).select("userId", "movieId", "rating").join(items, "movieId", "inner")
    return weighted_profiles(rows)


def centroid(items: DataFrame) -> DataFrame:
    """The mean of all item vectors; one row ``(vec)`` if they are dense,
    a row ``(idx, c)`` for each term that occurs if they are sparse."""
    if not is_sparse(items):
        return items.agg(vec_mean("vec").alias("vec"))
    n = items.agg(F.count(F.lit(1)).cast("double")).scalar()
    each = items.select(F.explode(entries("vec")).alias("e"))
    return each.groupBy(F.col("e.idx").alias("idx")).agg((F.sum("e.val") / n).alias("c"))
