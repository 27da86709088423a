"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import staged

MAX_STEPS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a long, b long) -> node, component (the smallest node it reaches); loops and repeats are allowed.

    A step rewrites the edge table and stages it. The minimum of a node is an aggregate with a map-side
    part, and joins go to one row for each node, so a star of any size is never gathered.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_STEPS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = staged(large.join(small, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")).select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(now) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = tuple(now)
    raise RuntimeError("components did not settle")
