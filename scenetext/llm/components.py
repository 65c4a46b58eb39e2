"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) for every id in ``edges(a, b)``.

    Large-star and small-star steps in turn: each links the neighbours of a
    node to the smallest of them, until every link points to the smallest node
    of its component. A few rounds are enough, as paths get shorter by a factor
    each time. A node with very many links is never gathered: its minimum is
    combined before the shuffle, and the join can be split.
    """
    links = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    last = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # after the large step every link points down; small: the larger ends take the least one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = kept(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            break
        last = now
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
