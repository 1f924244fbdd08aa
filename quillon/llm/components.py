"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import dropped, written


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of the links, root being the smallest node of its component.

    Alternates the large-star and small-star steps of the MapReduce literature until a round
    changes nothing: then each node points straight at its root. Each step is one minimum per
    node (combined before the shuffle), stored as a row for each node, and one join of two plain
    shuffles, which AQE splits where a node has very many links; rounds grow as the logarithm of the longest path. Loops and repeated links
    are harmless, an empty table gives an empty result.
    """
    spark, last = links.sparkSession, []
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = written(edges, "links", last)
    while True:
        now: list[str] = []
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "low", now)
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large", now)
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low", now)
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        fresh: list[str] = []
        after = written(small.select("e.u", "e.v").filter("u != v").distinct(), "links", fresh)
        for path in [*now, *last]:
            dropped(spark, path)
        last = fresh
        # a star's links: each node has one parent, and no parent is a child
        parents = after.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        chained = after.select(F.col("v").alias("u")).join(parents, "u", "left_semi").limit(1).count()
        edges = after
        if not chained and not parents.filter("n > 1").limit(1).count():
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
