"""Sorted sinks (T1, T8): Parquet folders whose files follow a sort order.

A global order is written by a range partitioning and a sort within each
partition: file k holds what comes before file k + 1, so a reader that takes
the files by name reads the rows in order. Every row's position is its place in
its file (from Parquet's row index) plus the rows of the files before it, a
table of one row for each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinelens.operators.joins import broadcast_if_small

FILE_ROW_BYTES = 256


def write_sorted(df: DataFrame, path: str, *keys: str) -> None:
    """``df`` in ``keys`` order (nulls first), as files that follow it."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their file and place in it; rows of each file."""
    rows = spark.read.parquet(path)
    rows = rows.select(*rows.columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return rows, rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))


def read_in_order(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The rows of a sorted folder with their 0-based position in ``name``."""
    rows, sizes = _placed(spark, path)
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = rows.join(broadcast_if_small(starts, len(rows.inputFiles()), FILE_ROW_BYTES), "_file")
    return joined.withColumn(name, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


def out_of_order(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """One row ``(files, rows, inside, borders)``: how many rows stand after a
    greater one in their file, and how many files begin with a row that is
    less than the last one of the file before (files without rows aside)."""
    rows, _ = _placed(spark, path)
    key = F.struct(*keys)
    keyed = rows.select("_file", "_row", key.alias("_key"))
    before = F.lag("_key").over(Window.partitionBy("_file").orderBy("_row"))
    inside = keyed.withColumn("_back", (before > F.col("_key")).cast("long"))
    files = inside.groupBy("_file").agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_back"), F.lit(0)).alias("inside"),
        F.min_by("_key", "_row").alias("first"), F.max_by("_key", "_row").alias("last"))
    last = F.lag("last").over(Window.orderBy("_file"))
    return files.withColumn("border", (last > F.col("first")).cast("long")).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("inside"), F.lit(0)).alias("inside"), F.coalesce(F.sum("border"), F.lit(0)).alias("borders"))
