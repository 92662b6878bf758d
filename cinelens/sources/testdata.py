"""Mapping of the driver's TPC-H-like tables onto movies, ratings and tags.

The driver's parquet files hold no movie data, so a fixed mapping turns
``part`` into the catalogue and ``lineitem`` joined with ``orders`` into
ratings and tags. The same mapping is given as DuckDB SQL (``VIEWS_SQL``) so
every oracle query starts from identical tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelens.config import NO_GENRES
from cinelens.functions.time import epoch_seconds


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    genres = F.when(F.col("p_size") % 17 == 0, F.lit(NO_GENRES)).otherwise(
        F.concat(
            F.col("p_type"),
            F.lit("|"),
            F.upper(F.try_element_at(words, F.lit(1))),
            F.lit("|"),
            F.try_element_at(words, F.lit(2)),
        )
    )
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("title"),
        genres.alias("genres"),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")


def _ratings_from(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
        epoch_seconds("o_orderdate").cast("bigint").alias("timestamp"),
    )


def _tags_from(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("l_returnflag")).alias("tag"),
        epoch_seconds("l_shipdate").cast("bigint").alias("timestamp"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratings_from(_order_lines(spark, sf_dir))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tags_from(_order_lines(spark, sf_dir))


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(movies, ratings, tags) as raw tables."""
    return movies(spark, sf_dir), ratings(spark, sf_dir), tags(spark, sf_dir)


def load_materialized(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like :func:`load`, with the lineitem-orders join written once to the
    checkpoint folder (only the columns both views use) and both views
    projected from it."""
    cols = ["o_custkey", "l_partkey", "l_quantity", "o_orderdate", "o_orderpriority", "l_returnflag", "l_shipdate"]
    lines = _order_lines(spark, sf_dir).select(*cols)
    # A single-row-group file scans as one task; spread it over the cores
    # once, so every later pass over ratings and tags runs in parallel.
    parallelism = spark.sparkContext.defaultParallelism
    if lines.rdd.getNumPartitions() < parallelism:
        lines = lines.repartition(parallelism)
    lines = lines.checkpoint(eager=True)
    return movies(spark, sf_dir), _ratings_from(lines), _tags_from(lines)


# The same three views for DuckDB, put in front of every oracle query.
VIEWS_SQL = """
movies AS (
  SELECT p_partkey AS movieId, p_name || ' ' || p_brand AS title,
         CASE WHEN p_size % 17 = 0 THEN '(no genres listed)'
              ELSE p_type || '|' || upper(string_split(p_name, ' ')[1])
                          || '|' || string_split(p_name, ' ')[2] END AS genres
  FROM part),
ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
tags AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         o_orderpriority || ' ' || l_returnflag AS tag,
         CAST(epoch(l_shipdate) AS BIGINT) AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
