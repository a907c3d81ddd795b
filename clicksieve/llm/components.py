"""Connected components by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicksieve.llm.common import keep_table


def _once(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) without direction, each once; none of a node with itself."""
    return pairs.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, label), one label per component, over linked nodes only.

    Each round every node moves to the neighbour (or itself) with the least hash
    under a fresh seed, and links between the nodes moved to remain. The number of
    nodes falls by a constant factor a round in expectation, whatever the shape of
    the graph. A link is one row, read from both ends only where neighbours are
    ranked. Links shrink with the nodes and never leave the executors; each round
    ends in a written table, so its lineage stays short. A label is a node of its
    component.
    """
    edges = keep_table(_once(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    labels = None
    seed = 0
    while not edges.isEmpty():
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), c.alias("to"))
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = both.groupBy("u").agg(F.min(rank(F.col("v"))).alias("best")) \
            .select("u", F.least(F.col("best"), rank(F.col("u")))["to"].alias("to"))
        moved = keep_table(moved, "moved")
        if labels is None:
            labels = moved.select(F.col("u").alias("node"), F.col("to").alias("label"))
        else:
            labels = keep_table(labels.join(moved, labels.label == moved.u, "left").select(
                "node", F.coalesce("to", "label").alias("label")), "labels")
        left = moved.select("u", F.col("to").alias("cu"))
        right = moved.select(F.col("u").alias("v"), F.col("to").alias("cv"))
        edges = keep_table(_once(edges.join(left, "u").join(right, "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))), "links")
    if labels is None:
        labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels


def merge_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) of ``connected_components`` after further links (a, b).

    The new links join components, so the old ones are not gone through again.
    """
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    merged = connected_components(links.join(of_a, "a", "left").join(of_b, "b", "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    to = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
    old = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return keep_table(old.union(merged.join(labels, "node", "left_anti")), "labels")
