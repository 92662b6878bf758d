"""Data profiling of the raw tables (D1-D15, A11-A18), one table each.

Plots of the reference become tables: histograms are bin counts, ranked
lists are ordered frames with an explicit limit (top-k is the feature).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.config import NO_GENRES
from cinelens.functions import text
from cinelens.operators.ordering import numbered
from cinelens.operators.selection import facts, order_statistics
from cinelens.operators.validate import null_counts_by_column
from cinelens.session import ensure_checkpoint_dir

# Genre names the catalogue format check accepts.
VALID_GENRES = [
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical",
    "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western", "IMAX",
]


def schema_table(df: DataFrame, name: str) -> DataFrame:
    """``(table, column, dtype, position, n_rows, n_cols)``."""
    spark = df.sparkSession
    cols = [(name, f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    meta = spark.createDataFrame(cols, "table string, column string, dtype string, position int")
    shape = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
    )
    return meta.join(shape, "table")


def null_counts(tables: dict) -> DataFrame:
    """Nulls per column of each table."""
    return reduce(DataFrame.unionByName, [null_counts_by_column(df, n) for n, df in tables.items()])


def blank_counts(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """D3: values that are empty after stripping, in tag, genres, title."""
    m = movies.agg(
        F.count_if(text.strip_ws("genres") == "").alias("genres"),
        F.count_if(text.strip_ws("title") == "").alias("title"),
    )
    t = tags.agg(F.count_if(text.strip_ws("tag") == "")).scalar()
    return m.select("*", t.alias("tag")).selectExpr(
        "stack(3, 'tag', tag, 'genres', genres, 'title', title) as (column, n_blank)"
    ).select("column", F.col("n_blank").cast("bigint").alias("n_blank"))


def no_genre_movies(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """D4 (P1 inverse, J7, A16): ``(n_no_genres, n_with_tags)``: movies
    marked as having no genres, and how many of them have tags."""
    none = movies.filter(F.col("genres") == F.lit(NO_GENRES)).select("movieId")
    tagged = none.join(tags.select("movieId"), "movieId", "inner").select("movieId").distinct()
    return none.agg(F.count(F.lit(1)).alias("n_no_genres")).select(
        "n_no_genres", tagged.agg(F.count(F.lit(1))).scalar().alias("n_with_tags")
    )


def duplicated_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose ``key`` occurs more than once.

    Counted by a grouped aggregate and a semi join, so a very common key is
    combined map-side instead of filling one window partition. The keys are
    written first: against a plain table AQE splits a skewed key's rows, which
    it does not against an aggregate on the join key.
    """
    ensure_checkpoint_dir(df.sparkSession)
    dup_keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(key).checkpoint(eager=True)
    return df.join(dup_keys, key, "left_semi")


def genre_pattern(genres: list = VALID_GENRES) -> str:
    """Whole-string, case-insensitive format check for genres (RX9): the
    no-genre marker, or names joined by pipes. Names are quoted, so a caller's
    may hold any character."""
    one = "(?:" + "|".join(rf"\Q{g}\E" for g in genres) + ")"
    # Fixed form: marker, or name (pipe name)*.
    return rf"(?i)^(?:\Q{NO_GENRES}\E|{one}(?:[|]{one})*)$"


def malformed_genres(movies: DataFrame, genres: list = VALID_GENRES) -> DataFrame:
    """D6 (X13): rows whose genres do not match the format."""
    return movies.filter(~F.col("genres").rlike(genre_pattern(genres)))


def duplicate_pairs(ratings: DataFrame) -> DataFrame:
    """``(userId, movieId, duplicates)`` for pairs rated more
    than once, most repeated first."""
    pairs = ratings.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("duplicates"))
    return pairs.filter(F.col("duplicates") > 1).orderBy(F.desc("duplicates"), "userId", "movieId")


def ranges(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """D9 (A14): min and max of rating and of both timestamps."""
    r = ratings.agg(
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.min("timestamp").alias("min_rating_ts"),
        F.max("timestamp").alias("max_rating_ts"),
    )
    return r.select(
        "*",
        tags.agg(F.min("timestamp")).scalar().alias("min_tag_ts"),
        tags.agg(F.max("timestamp")).scalar().alias("max_tag_ts"),
    )


def distinct_tags(tags: DataFrame) -> DataFrame:
    """D10 (T8, U2): every distinct tag, byte order."""
    return tags.select("tag").distinct().orderBy("tag")


def positions(df: DataFrame, col: str) -> DataFrame:
    """``(_pos, col)``: 0-based rank of every non-null value in sorted order
    (see :func:`cinelens.operators.ordering.numbered`)."""
    values = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    return numbered(values, "_x").select("_pos", F.col("_x").alias(col))


def _ranks(n: int, q: float, interpolation: str) -> tuple[int, int, float]:
    """(lower rank, upper rank, share of the upper one) of a quantile."""
    at = q * (n - 1)
    if interpolation == "nearest":
        rank = math.floor(at + 0.5)
        return rank, rank, 0.0
    return math.floor(at), math.ceil(at), at - math.floor(at)


def _quantiles(df: DataFrame, known: dict, qs, interpolation: str) -> dict:
    """``{(column, q): value}`` of all columns of ``known`` (see
    :func:`cinelens.operators.selection.facts`); None for a column of nulls."""
    if interpolation not in ("nearest", "linear"):
        raise ValueError(f"unknown interpolation {interpolation!r}")
    sizes = {c: int(sum(f[:4])) for c, f in known.items()}
    places = {(c, q): _ranks(n, float(q), interpolation) for c, n in sizes.items() if n for q in qs}
    wanted: dict = {}
    for (c, _), (lo, hi, _) in places.items():
        wanted.setdefault(c, set()).update((lo, hi))
    found = order_statistics(df, wanted, known)
    out = {}
    for c in known:
        for q in qs:
            lo, hi, share = places.get((c, q), (None, None, 0.0))
            low, high = found.get((c, lo)), found.get((c, hi))
            out[c, q] = low if low is None or lo == hi or low == high else low + share * (high - low)
    return out


def quantiles(df: DataFrame, col: str, qs=(0.25, 0.5, 0.75), interpolation: str = "nearest") -> DataFrame:
    """Exact quantiles ``(q, value)`` without gathering or sorting the values.

    ``nearest``: the value at rank ``round(q * (n - 1))`` (halves away from
    zero); ``linear``: interpolation between the ranks around it. The ranks are
    selected by histogram refinement (:mod:`cinelens.operators.selection`).
    """
    known = {col: df.agg(facts(F.col(f"`{col}`").cast("double"))).first()[0]}
    found = _quantiles(df, known, qs, interpolation)
    return df.sparkSession.createDataFrame([(float(q), found[col, q]) for q in qs], "q double, value double")


_MOMENTS = ["count", "null_count", "mean", "std", "min", "max"]
_QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: list, interpolation: str = "nearest") -> DataFrame:
    """D11 (A15): count, null_count, mean, std, min, 25/50/75%, max per
    column as ``(column, statistic, value)``. Moments of all columns come from
    one aggregate; quartiles are exact, nearest-rank by default (as the
    reference's describe), selected for all columns together in a few passes
    that count, so the number of scans doesn't depend on the columns."""
    x = lambda c: F.col(f"`{c}`").cast("double")
    row = df.agg(*[
        F.struct(F.array(F.count(x(c)).cast("double"), F.count_if(F.col(f"`{c}`").isNull()).cast("double"), F.avg(x(c)), F.stddev_samp(x(c)),
                         F.min(x(c)), F.max(x(c))), facts(x(c))).alias(f"_m{i}")
        for i, c in enumerate(columns)]).first()
    quartiles = _quantiles(df, {c: r[1] for c, r in zip(columns, row)}, _QUARTILES, interpolation)
    rows = [(c, name, value) for c, r in zip(columns, row) for name, value in zip(_MOMENTS, r[0])]
    rows += [(c, f"{q:.0%}", quartiles[c, q]) for c in columns for q in _QUARTILES]
    return df.sparkSession.createDataFrame(rows, "column string, statistic string, value double")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, count)`` of one column."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def genre_list_counts(movies: DataFrame, top: int | None = 5) -> DataFrame:
    """D12 (A13, T6): counts of whole genre lists (``A|B`` split on the
    pipe, as the notebook does), most common first, ties by list."""
    lists = movies.groupBy(F.split(F.col("genres"), r"[|]").alias("genre_list")).agg(
        F.count(F.lit(1)).alias("count")
    )
    out = lists.orderBy(F.desc("count"), F.array_join("genre_list", "|"))
    return out.limit(top) if top else out


def single_genre_counts(movies: DataFrame) -> DataFrame:
    """D12 addition: counts of single genres after splitting lists."""
    one = movies.select(F.explode(F.split(F.col("genres"), r"[|]")).alias("genre"))
    return one.groupBy("genre").agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max: ``(bin, lo, hi, count)``.

    The maximum belongs to the last bin; empty bins are listed with 0.
    Bounds are scalar subqueries (min and max of the column).
    """
    lo = df.agg(F.min(column).cast("double")).scalar()
    hi = df.agg(F.max(column).cast("double")).scalar()
    x = F.col(column).cast("double")
    width = (hi - lo) / F.lit(bins)
    idx = F.when(width > 0, F.least(F.floor((x - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = df.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (lo + width * F.col("bin")).alias("lo"),
        (lo + width * (F.col("bin") + 1)).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )


def top_rated(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """D14 (A12, T5, J9): the ``n`` movies with most non-null ratings,
    ties by movieId, with title and genres."""
    counts = ratings.groupBy("movieId").agg(F.count("rating").alias("rating_count"))
    top = counts.orderBy(F.desc("rating_count"), "movieId").limit(n)
    # top ⟕ movies, written as movies ⟖ broadcast(top): the broadcast side
    # is the n-row list, never the catalogue.
    return movies.select("movieId", "title", "genres").join(F.broadcast(top), "movieId", "right").select(
        "movieId", "rating_count", "title", "genres"
    )


def user_activity(ratings: DataFrame) -> DataFrame:
    """D15 (A12): ``(userId, rating_count)``, most active first."""
    act = ratings.groupBy("userId").agg(F.count("rating").alias("rating_count"))
    return act.orderBy(F.desc("rating_count"), "userId")



def preview(df: DataFrame, n: int = 5, order: str | None = None) -> DataFrame:
    """The first ``n`` rows (by ``order`` when given, for a stable
    answer); the limit is the feature."""
    return (df.orderBy(order) if order else df).limit(int(n))


def activity_histogram(ratings: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of ratings per user (A12 + A18)."""
    per_user = ratings.groupBy("userId").agg(F.count("rating").alias("rating_count"))
    return histogram(per_user, "rating_count", bins)
