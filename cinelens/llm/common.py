"""Shared pieces of the operators: table reading, folds, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelens.session import ensure_checkpoint_dir, ship_package

#: Rows handled at a time inside a task, so that few long texts are held as
#: Python objects together.
SLICE_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers and name the checkpoint folder."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, k: int) -> Column:
    """``crc32(doc_id as text) mod k``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(k)


def unit_hash(*cols) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow batches cut to at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
