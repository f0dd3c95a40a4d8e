"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ribolith.operators.ranges import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the undirected links `edges` (a, b): root is the least node that a node reaches.

    Two steps in turn until nothing changes. First each node links its larger neighbours to the least one that it has, itself
    included; then its smaller ones. Paths become shorter by about half in a round, so a chain of n links takes some log n
    rounds. The least neighbour is an aggregate that is joined back: no node's neighbours are gathered in a row. Each round is staged. Nodes that
    have a link to themselves alone, and nulls, are not listed.
    """

    def least(pairs):
        return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        down = both.join(least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = least(down)
        turned = down.join(own, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(turned.unionByName(own.select("a", F.col("m").alias("b"))).distinct())
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = seen
