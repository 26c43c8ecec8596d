"""Connected components by alternating large-star and small-star steps.

Each step is one aggregate and one join over the edge table, so work is spread over
all tasks; the number of rounds is logarithmic in the longest path.  Minima are
checkpointed before they are joined, which leaves both join sides as plain shuffles
that Spark can split when one node holds a large share of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut


def _digest(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _star(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v) rows and the least of u and its neighbours, per u."""
    least = cut(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return pairs, least


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (node, label): label is the smallest node reachable.

    Null ends, loops and repeated edges are ignored; nodes without an edge to another
    node are not returned.  An empty edge table gives an empty result.
    """
    e = (edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("b"), F.col("a").isNotNull().alias("k"))
         .where(F.col("x").isNotNull() & F.col("b").isNotNull() & (F.col("x") != F.col("b")))
         .select(F.col("x").alias("a"), "b").distinct())
    e = cut(e)
    seen = _digest(e)
    while seen[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        both, least = _star(both)
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        down, least = _star(down)
        small = down.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        e = cut(small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct())
        now = _digest(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("label"))
    return nodes.union(roots)
