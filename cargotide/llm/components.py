"""Connected components of a link table: alternating large-star and small-star steps.

All state is in tables; a node with very many links is spread over salts, and a node's smallest
neighbour is found with map-side combining, so no step gathers the links of one node in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

SALTS = 32


def _with_smallest(edges: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m) with m the smallest of u and its neighbours."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    least = (salted.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.collect_set("salt").alias("salts"))
             .select("u", "m", F.explode("salts").alias("salt")))
    return salted.join(least, ["u", "salt"]).drop("salt")


def connected_components(links: DataFrame, a: str, b: str, most_rounds: int = 50) -> DataFrame:
    """(node, component) for every node that has a link to another; component is the smallest
    reachable node. Null ends and self links are ignored; repeated links do no harm."""
    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    edges = stored(ends.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = _with_smallest(large)  # every v is below its u here
        step = down.select("u", F.col("m").alias("v")).unionByName(down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        new = stored(step.distinct(), "links")
        # done when no node stands on both sides (all stars) and each leaf has one centre
        leaves = new.select("u").distinct().count()
        if leaves == new.count() and new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges = new
    raise RuntimeError("components did not settle")
