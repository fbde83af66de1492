"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.common import settled

MAX_ROUNDS = 40  # rounds grow with the logarithm of the longest path


def _least(pairs: DataFrame) -> DataFrame:
    """u, v and the least of u and its neighbours in ``pairs``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    found = _least(edges)
    m = F.col("m").alias("v")
    return found.select(F.inline(F.array(F.struct(F.col("v").alias("u"), m), F.struct("u", m))))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of edges (u > v) has one edge down or edges up only: v is then its root."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")),
            )
        )
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not nodes.where("down + up > 1").agg(F.count("*")).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of edges (u, v); edges to oneself count not."""
    start = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = settled(start.where("u <> v").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _are_stars(now):
            break
        large = _large_star(now).where("u <> v").distinct()
        now = settled(_small_star(large).where("u <> v").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
