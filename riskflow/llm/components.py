"""Connected components of links by hooking and contraction, all in stored steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import stored


def _roots(parents: DataFrame) -> DataFrame:
    """From (node, parent) without cycles: the last ancestor of each node, by doubling steps."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_next"))
        longer = stored(
            parents.join(up, "parent", "left").select("node", F.coalesce("_next", "parent").alias("parent"), F.col("_next").isNotNull().alias("_moved")),
            "parents",
        )
        parents = longer.select("node", "parent")
        if longer.filter("_moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of `links` (a, b) that has a smaller one in its component; label is the smallest.

    In each round every node hooks to its smallest neighbour below it, chains are shortened to their ends, and links
    are carried over to these; those that remain between different ends go to the next round.
    """
    rest = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    labels = None
    while not rest.isEmpty():
        roots = _roots(stored(rest.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "hooks"))
        ends = roots.select(F.col("node").alias("label"), F.col("parent").alias("_root"))
        new = roots.select("node", F.col("parent").alias("label"))
        if labels is not None:
            moved = labels.join(ends, "label", "left").select("node", F.coalesce("_root", "label").alias("label"))
            new = moved.unionByName(new)
        labels = stored(new, "labels")
        of_a = roots.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        carried = rest.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        rest = stored(carried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
