"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node joins its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node joins its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v) that is not its component's smallest.

    The edges are written to the shared folder after each pair of steps, which
    cuts the lineage; the number of passes grows with the logarithm of the
    components' diameter.  Nothing but two counts reaches the driver.
    """
    now, before = stored(edges.where("u <> v").select("u", "v"), name), None
    while True:
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if sign["n"] == 0 or (before is not None and tuple(sign) == before):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = tuple(sign)
        now = stored(_small_star(_large_star(now)), name)
