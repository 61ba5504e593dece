"""Connected components of a graph of long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import drop_scratch, settle

#: Each pair of rounds at least halves the longest path, so this covers any graph that fits a cluster.
MOST_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """A round on edges from a greater to a smaller end: a large star, then a small one.

    First the greater neighbours of each node hang on the smallest of it and its
    neighbours, then each node and its smaller neighbours on the smallest of these.  No
    smallest neighbour has to be looked for on both sides: it stands in ``b`` or there is none.
    """

    def least(frame: DataFrame) -> DataFrame:
        return frame.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))

    first = least(edges)
    large = edges.join(first, edges["b"] == first["node"], "left").select("a", F.coalesce("m", "b").alias("b"))
    second = least(large)
    small = large.join(second, large["a"] == second["node"]).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return small.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of an edge ``(a, b)``; a component is named by its smallest node.

    Edges may be repeated, may point either way and may be loops; a null end
    makes no edge; no edges give no rows.  Each round is written to the shared
    folder, so a lost executor costs one round, and only its row count and a
    checksum reach the driver.
    """
    spark = edges.sparkSession
    kept = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    stars, path = settle(kept, "stars")
    before = None
    for _ in range(MOST_ROUNDS):
        found = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if found == before or not found["n"]:
            break
        before = found
        after, new_path = settle(_stars(stars), "stars")
        drop_scratch(spark, path)
        stars, path = after, new_path
    else:
        raise RuntimeError("components did not settle")
    members = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
