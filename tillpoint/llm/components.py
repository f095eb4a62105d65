"""Connected components of a table of links, by alternating star steps.

A large-star step links every larger neighbour of a node to the least node it sees; a small-star step does so for the
smaller neighbours. Each step joins and groups the links, keeps the components, and shortens paths, so their number
grows with the logarithm of the longest path. They end when every node has only its link to the least node of its
component, which a count of each node's smaller and larger neighbours tells without a further step: every stage takes
some megabytes of the driver, whatever the number of links. Links are narrow rows; a node with very many neighbours is
combined in each task before it is grouped, and its join is left to Spark's splitting of skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import staged

#: Links in one file of a step's result; a step on few links writes few files.
IN_A_FILE = 500_000


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node that links reach) for every node of ``links`` (a, b: longs)."""

    def both_ways(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        near = both_ways(edges) if larger else edges  # edges: a > b
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = near.join(least, "a")
        if larger:
            out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = (joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .unionByName(least.select("a", F.col("m").alias("b"))))
        return out.filter("a != b").distinct()

    edges = staged(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while (at := unsettled(edges))["nodes"]:
        files = max(1, -(-at["links"] // IN_A_FILE))
        edges = staged(star(star(edges, True), False).coalesce(files), "stars")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def unsettled(edges: DataFrame) -> dict[str, int]:
    """The number of ``links`` of ``edges`` (a > b, each once), and of ``nodes`` with several smaller neighbours, or smaller and larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("below")))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.count("*").alias("ends"))
    found = nodes.agg(F.coalesce(F.sum("below"), F.lit(0)).alias("links"), F.count_if(F.expr("below > 1 OR below = 1 AND ends > 1")).alias("nodes"))
    return found.first().asDict()
