"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a minimum per node and a join back, so no task holds the neighbours of a node.
Each round goes to the shared folder, which keeps plans short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.workspace import stored


def _star(edges: DataFrame) -> DataFrame:
    """Point every neighbour ``v`` of ``u`` at the smallest of ``u`` and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    return edges.join(least, "u").select("u", "v", "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of ``links`` (u, v): the smallest id it can reach.

    Links with a null end and links of a node with itself say nothing and are ignored; no links
    give no rows.
    """
    edges = links.select("u", "v").filter("u <> v").distinct()
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)).distinct(), "edges")
        # Two order-free sums tell whether the step changed anything.
        row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40)))).first()
        if tuple(row) == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = tuple(row)
