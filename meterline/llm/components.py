"""Connected components of links between ids, by rounds of joins that end with no open link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import forget, stored


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b); root is the smallest id reachable.

    Each round hangs every component below its smallest neighbour, follows the new parents
    to their end, and rewrites the links between components that remain.  A component at
    least halves its links' ends per round.  Minima are taken map-side first, so a hub with
    very many links costs no more than its rows.
    """
    labels: DataFrame | None = None
    open_links = stored(links.select("a", "b").filter(F.col("a") != F.col("b")), "links")
    while True:
        both = open_links.unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stored(
            both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("parent")),
            "parents",
        )
        if parents.isEmpty():
            break
        parents = _roots(parents)
        renamed = parents.select(F.col("a").alias("root"), F.col("parent").alias("_to"))
        if labels is None:
            moved = parents.select(F.col("a").alias("id"), F.col("parent").alias("root"))
        else:
            moved = labels.join(renamed, "root", "left").select("id", F.coalesce("_to", "root").alias("root"))
        ends = parents.select(F.col("a").alias("_end"), F.col("parent").alias("_to"))
        left = open_links.join(ends, F.col("a") == F.col("_end")).select(F.col("_to").alias("a"), "b")
        right = left.join(ends, F.col("b") == F.col("_end")).select("a", F.col("_to").alias("b"))
        remaining = right.filter(F.col("a") != F.col("b")).distinct()
        old = [open_links, parents] + ([labels] if labels is not None else [])
        labels, open_links = stored(moved, "labels"), stored(remaining, "links")
        forget(*old)
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("a").alias("root")).limit(0)
    return labels


def _roots(parents: DataFrame) -> DataFrame:
    """Follow parents to their end; every parent is smaller than its child, so there are no cycles."""
    while True:
        above = parents.select(F.col("a").alias("_at"), F.col("parent").alias("_above")).filter("_at != _above")
        jumped = parents.join(above, F.col("parent") == F.col("_at"), "left").select(
            "a", F.coalesce("_above", "parent").alias("parent"), F.col("_at").isNotNull().alias("_moved")
        )
        before, parents = parents, stored(jumped, "parents")
        moved = not parents.filter("_moved").isEmpty()
        forget(before)
        parents = parents.drop("_moved")
        if not moved:
            return parents
