"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (its smallest reachable node) for every node of an edge.

    Alternates two steps until nothing changes: every node hands its larger neighbours
    to its smallest one, then its smaller ones.  The number of rounds grows with the
    log of the longest path.  Minima are summed up before the exchange, a node with
    very many links is a skewed join, and every round is a written table.
    """
    pairs = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u > v").distinct()
    pairs = cut_lineage(pairs)
    if pairs.isEmpty():
        return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        # Larger neighbours: (u, x) with x > u becomes (x, smallest of u and its neighbours).
        both = pairs.union(pairs.select("u", "v"))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")) \
            .select("n", F.least("n", "m").alias("m"))
        large = pairs.join(least, pairs.v == least.n).select(F.col("m").alias("v"), "u") \
            .union(least.where("m < n").select(F.col("m").alias("v"), F.col("n").alias("u"))) \
            .where("u > v").distinct()
        large = cut_lineage(large)
        # Smaller neighbours: every node keeps its smallest one and hands the others over.
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u")
        small = small.select(F.col("m").alias("v"), F.col("v").alias("u")).where("u > v") \
            .union(first.select(F.col("m").alias("v"), "u")).distinct()
        pairs = cut_lineage(small)
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    top = pairs.select(F.col("v").alias("node")).distinct().join(
        pairs.select(F.col("u").alias("node")), "node", "left_anti")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(top.select("node", F.col("node").alias("component")))
