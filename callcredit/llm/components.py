"""Connected components of a graph of links, by alternating stars.

Every round lets each node's larger neighbours point to its smallest one, then
each node's smaller neighbours (Kiveris and others, 2014); rounds grow with the
logarithm of the graph. Minima are aggregated before the shuffle, so a node
with very many links costs one row a task, and no component is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.llm.storage import staged


def _point_to_least(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """(node, other) rows to (v, least) with the least of node and its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    joined = pairs.join(least, "node")
    if larger_only:
        return joined.where(F.col("other") > F.col("node")).select(F.col("other").alias("a"), F.col("least").alias("b"))
    return joined.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))).where(F.col("a") != F.col("b"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every linked node and the least node it reaches."""
    edges = staged(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col("a") != F.col("b")).distinct())
    before = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        large = _point_to_least(both, larger_only=True).distinct()
        small = _point_to_least(
            large.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")), larger_only=False)
        edges = staged(small.distinct())
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if before == now:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
