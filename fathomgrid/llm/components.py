"""Connected components by contraction, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected links (a, b); component is the smallest node.

    Each round every node moves to the neighbour (or itself) that comes first in an order shuffled anew,
    and links follow. The shuffled order shrinks chains by a constant factor per round, so there are
    few rounds, and the moves of all of them are put together at the end.
    """
    edges = store(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("at", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        key = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("k"), F.col(c).alias("n"))
        moves = both.groupBy("a").agg(F.least(F.min(key("b")), F.first(key("a"))).alias("to"))
        moves = store(moves.select(F.col("a").alias("from"), F.col("to.n").alias("to")), "moves")
        labels = labels.join(moves.withColumnRenamed("from", "at"), "at", "left").select(
            "node", F.coalesce("to", "at").alias("at")
        )
        edges = (
            edges.join(moves.select(F.col("from").alias("a"), F.col("to").alias("x")), "a")
            .join(moves.select(F.col("from").alias("b"), F.col("to").alias("y")), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        edges = store(edges, "links")
        turn += 1
    labels = store(labels, "labels")
    smallest = labels.groupBy("at").agg(F.min("node").alias("component"))
    return labels.join(smallest, "at").select("node", "component")


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only the links between different components are contracted.

    `labels` is a stored (node, component) table; nodes it lacks are components of their own.
    """
    at = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    known = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    between = store(
        known.select("a", "b", F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y")), "between"
    )
    joined = store(components(between.select(F.col("x").alias("a"), F.col("y").alias("b"))), "joined")
    met = between.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    every = labels.unionByName(met.join(labels, "node", "left_anti").withColumn("component", F.col("node")))
    above = joined.select(F.col("node").alias("component"), F.col("component").alias("above"))
    return every.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
