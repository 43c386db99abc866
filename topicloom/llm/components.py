"""Connected components of a graph given as a table of edges, by alternating large and small stars.

Each round hangs the neighbours of a vertex on the smallest of them, first the larger neighbours, then the smaller
ones; the rounds grow with the logarithm of the vertices. Minima are aggregated before the shuffle, and the joins are
on one small row for a vertex, so a vertex with very many edges is split like any skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of each vertex with an edge to another; the root is the smallest of its component. Nulls have none."""
    pairs = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
    pairs = stored(pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("v") > F.col("u"))).distinct(), "edges")
    before = None
    while True:
        both = pairs.select(F.explode(F.array(F.struct(F.col("v").alias("x"), F.col("u").alias("y")), F.struct(F.col("u").alias("x"), F.col("v").alias("y")))).alias("e")).select("e.*")
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.*")
        pairs = stored(small.filter("v > u").distinct(), "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = pairs.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root"))
    tops = pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return stored(roots, "roots").unionByName(stored(tops, "roots"))
