"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize, shuffles


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges: (a, b) of longs. node, root of every node in an edge; root is the smallest node of its component.

    Each round points every node's larger neighbours (large star), then its
    smaller ones (small star), to its smallest neighbour. The minimum is taken
    with map-side combining, so a node with very many neighbours is one row for
    each task, and it meets them again by a broadcast of the few such nodes.
    Rounds grow as the logarithm of the longest chain. Rows with a null and
    loops play no part.
    """
    now = edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct()
    now = materialize(now, "components")
    last, n = None, shuffles(edges)
    share = max(1.0, 2 * now.count() / n)
    for _ in range(rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))
        large = join_hot(both.where("v > u"), low, ["u"], "degree", share).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
        small = join_hot(large, low, ["u"], "degree", share).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "components")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == last:
            break
        last, share = mark, max(1.0, 2 * mark[0] / n)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
