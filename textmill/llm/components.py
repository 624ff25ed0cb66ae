"""Connected components of a link table, by alternating star contractions.

Each round points all larger neighbours of a node, then the node itself, at the smallest id around it, with grouped minima
and joins alone: no neighbour list is gathered, a node with very many links costs a partial minimum
per task. Rounds are written to the scratch folder, so a lost executor repeats one round at most. They end as soon as
all links form stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import kit


def stars(edges: DataFrame) -> bool:
    """Whether every node either points at one other or is pointed at: then ``v`` is the component of ``u``."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionAll(edges.select("v", F.lit(0), F.lit(1)))
    placed = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not placed.agg(F.max((F.col("out") + F.col("into")) > 1)).first()[0]


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); the component is its smallest node."""
    now = kit.written(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), folder, f"{name}-0")
    number = 0
    while not stars(now):
        number += 1
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node that is its own minimum keeps its links through its neighbours' rows
        large = large.where(F.col("u") != F.col("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        moved = small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kit.written(moved.unionAll(down.select("u", F.col("m").alias("v"))).distinct(), folder, f"{name}-{number}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v"), F.col("v")).distinct())
