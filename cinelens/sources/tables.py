"""Schemas and scans of the three input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelens.session import stored

MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)
RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
TAGS_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

SCHEMAS = {"movies": MOVIES_SCHEMA, "ratings": RATINGS_SCHEMA, "tags": TAGS_SCHEMA}


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one raw CSV table with a declared schema (no inference pass).

    A header row is expected; quotes inside a quoted field are doubled
    (``"A ""q"" B, The"``), hence ``escape='"'``. Empty fields read as null.
    """
    return (
        spark.read.schema(SCHEMAS[table])
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


#: Column of the text of a line that does not fit its schema.
BROKEN = "_broken_line"


def read_checked(spark: SparkSession, path: str, table: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of one raw CSV table that may hold broken lines.

    A line with too few or too many fields, a field that is not of its column's
    type or an unclosed quote goes to ``quarantine(line)``; every other line is
    a row, as :func:`read_csv` gives it. The file is parsed once, whole lines
    at that (a pruned read would not see a bad field), and both tables are read
    from what was stored.
    """
    schema = T.StructType([*SCHEMAS[table].fields, T.StructField(BROKEN, T.StringType())])
    parsed = stored(
        spark.read.schema(schema)
        .option("header", header)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .csv(path)
    )
    good = parsed.filter(F.col(BROKEN).isNull()).drop(BROKEN)
    return good, parsed.filter(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line"))


def read_movielens(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``movies.csv``, ``ratings.csv`` and ``tags.csv`` of one folder."""
    return tuple(read_csv(spark, f"{folder.rstrip('/')}/{t}.csv", t) for t in ("movies", "ratings", "tags"))
