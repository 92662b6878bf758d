"""Global positions of rows in a sort order, without one task for all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.operators.joins import broadcast_if_small
from cinelens.session import ensure_checkpoint_dir


def numbered(df: DataFrame, *keys, name: str = "_pos") -> DataFrame:
    """``df`` with ``name``: the 0-based position of each row in ``keys``
    order (equal keys in any order).

    The range-partitioned, sorted rows are written once, tagged with their
    partition and place in it. Counts and positions both come from that one
    table: a range partitioning samples its input, so two evaluations of it
    may cut at different borders and must not be combined. The counts are one
    row for each partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    part, place = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    held = tagged.withColumn("_part", part)
    joined = held.join(broadcast_if_small(offsets, tagged.rdd.getNumPartitions(), 24), "_part")
    return joined.select(*df.columns, (F.col("_off") + place).alias(name))
