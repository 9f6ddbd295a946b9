"""Connected components of a link table, by alternating large and small stars.

Each half step is a grouped minimum (combined on the map side) and a join of the links with it; the
links are written to the shared folder after each step, so no plan grows and a lost executor costs
only its own tasks. The number of steps grows with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.llm.common import cut_lineage


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
    moved = down.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v")))


def components(links: DataFrame, most_steps: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u, v: long); component is its smallest node.

    Nulls and self-links are left out; a node without links does not appear.
    """
    links = cut_lineage(links.where("u is not null and v is not null and u != v").select("u", "v").distinct())
    seen = None
    for _ in range(most_steps):
        links = cut_lineage(_small(_large(links)).where("u != v").distinct())
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {most_steps} steps")
    inner = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return inner.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
