"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.storage import stored

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node of its component.

    Alternating large-star and small-star steps: every step links a node's
    neighbours to the smallest of them, with one aggregation (pre-aggregated
    before the shuffle, so a node of many edges is no hot group) and one join
    on the node.  The edge list is stored after each round, by one job whose
    files the next round reads in as few tasks as their size asks for.  It ends
    when a round changes nothing, in about the logarithm of the longest path.
    """
    e = stored(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
               .where("hi <> lo").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.join(least, "hi").where("lo > hi and lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(
            F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x"))
        e = stored(small.select("x.hi", "x.lo").where("hi <> lo").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components: no end after {MAX_ROUNDS} rounds")
