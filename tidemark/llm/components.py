"""Connected components of an edge table, by alternating stars.

Edges stay distributed. A large star hangs a vertex's larger neighbours on its
smallest one, a small star the smaller ones; the two alternate until nothing
moves. Every round is a grouped minimum and a join, and is written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import dropped, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("at")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
    hung = down.join(least, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v"))).where("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex of `edges` (u long, v long) that is not the
    smallest of its component, whose smallest vertex is root. Loops, repeated
    edges and an empty table are allowed; a null end is not an edge."""
    now = staged(edges.where("u != v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct(), "stars")
    mark = None
    while True:
        after = staged(_small_star(_large_star(now)), "stars")
        dropped(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before or not mark[0]:
            return now.select("u", F.col("v").alias("root"))
