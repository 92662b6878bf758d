"""Connected components of a link table, as DataFrame jobs.

Every round each node takes the smallest id among itself and its neighbours
as its parent; parents are followed to the end by doubling (a chain of n in
log n steps), which is a local minimum; and the links are rewritten to these.
Links within one vanish. A link's larger end is never a local minimum, so the
graph shrinks every round, and in stars and chains, which the similarity joins
give, to a point within a few. The minimum is a
partial aggregate, so a node with very many links needs no large task; joins
are between plain tables, which AQE may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.session import release, stored


def _follow(table: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    p = parent.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
    return table.join(p, table[column] == p["_n"], "left").withColumn(column, F.coalesce("_p", column)).drop("_n", "_p")


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, smaller node first."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node with a link to
    another one. ``links(a, b)``: two longs; order and repeats don't matter."""
    edges = stored(_oriented(links))
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")))
    while not edges.isEmpty():
        parent = stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")))
        while True:
            # A root has no parent of its own, so a row changes until it names one.
            further = stored(_follow(parent.withColumn("old", F.col("parent")), "parent", parent))
            release(parent)
            parent, changed = further, further.filter("old <> parent")
            if changed.isEmpty():
                break
            parent = further.drop("old")
            parent.stored_path = further.stored_path
        named = stored(_follow(labels, "component", parent))
        rest = stored(_oriented(_follow(_follow(edges, "a", parent), "b", parent)))
        release(labels, edges, parent)
        labels, edges = named, rest
    release(edges)
    return labels
