"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, root)`` for every id on a link: the smallest id it reaches. Links with a null end are ignored.

    Each step is a minimum per node, combined before the shuffle, and a join to that one row per node, so a node with
    any number of links is no group in one task. Rounds grow with the logarithm of the longest chain.
    """
    now = keep(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").transform(_small_star))
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 16))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
        seen = mark
        now = keep(_small_star(_large_star(now)))
