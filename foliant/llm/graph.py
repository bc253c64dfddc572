"""Connected components of links between documents, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import plain


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``): the smallest node that each node of ``edges`` (``a``, ``b``) reaches.

    Large-star and small-star rounds: every node links its greater neighbours, then its smaller ones, to the smallest
    node it knows; about log(n) rounds. A node's minimum is an aggregate, written before it is joined back, so
    that the join can split the links of a node that has many.
    """
    links = plain(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        # large star
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = plain(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = plain(both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # small star
        least = plain(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        met = large.join(least, "u")
        links = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        links = plain(links, "links")
        now = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
