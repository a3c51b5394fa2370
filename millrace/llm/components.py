"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import saved


def _links_both_ways(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of a table of links ``a``, ``b``; the root is the same for all of a component.

    Each round joins every node to its smallest neighbour, follows the joins to their ends, and keeps only the
    links between the ends. An end that still has links has a smaller neighbour then, so it joins in the next
    round. Rounds are written tables.
    """
    links = saved(_links_both_ways(links).distinct(), "links")
    labels = None
    while not links.isEmpty():
        joined = saved(links.groupBy("a").agg(F.min("b").alias("b"))
                       .select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "joined")
        # a node that was joined to may itself have joined another: follow until nothing moves
        joined = _followed(joined)
        labels = joined if labels is None else saved(
            labels.alias("l").join(joined.alias("j"), F.col("l.to") == F.col("j.node"), "left")
            .select("l.node", F.coalesce("j.to", "l.to").alias("to")), "labels")
        ends = links.where("a < b")
        for end in ("a", "b"):
            ends = (ends.join(joined, ends[end] == joined["node"]).drop(end, "node").withColumnRenamed("to", end))
        links = saved(_links_both_ways(ends).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels.withColumnRenamed("to", "root")


def _followed(joined: DataFrame) -> DataFrame:
    """Chains of joins shortened by half each round until every node points to the end of its chain."""
    while True:
        n, t = joined.alias("n"), joined.alias("t")
        further = saved(n.join(t, F.col("n.to") == F.col("t.node")).select(
            "n.node", F.col("t.to").alias("to"), (F.col("t.to") != F.col("n.to")).alias("moved")), "joined")
        joined = further.drop("moved")
        if further.where("moved").isEmpty():
            return joined
