"""Connected components by alternating star contractions (Kiveris et al., Connected Components in MapReduce and Beyond)."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import store
from marketloom.session import discard


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge to another; root is the smallest node of its component.

    ``edges`` has columns a and b of one ordered type; direction, repeats and loops do not matter. No group is
    gathered: the rounds are aggregations of minima and joins, which Spark splits where a node is hot.
    Every round is stored, the one before is removed then, and the rounds end when the edges are stars.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = store(pairs, "edges")
    before = None
    for number in count():
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = store(large.filter("a <> b").distinct(), f"large_{number}")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        small = small.select("b", "least").union(small.select("a", "least")).toDF("a", "b")
        old, pairs = pairs, store(small.filter("a <> b").distinct(), f"small_{number}")
        discard(old, large)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select("b", "b").distinct())
