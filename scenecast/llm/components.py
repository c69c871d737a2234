"""Connected components of a link table, by alternating star contraction.

Links are (a, b) rows of 64-bit ids.  A large star ties every neighbour that
is larger than a node to the smallest id the node knows; a small star does the
same with the smaller ones.  Both keep the components as they are; when a round
changes nothing, every node hangs on the smallest id of its component.
Each round is written to the shared folder; the one before it and what both stars
wrote on the way are deleted.

A hub with very many neighbours is never gathered: its smallest neighbour is a
``min`` (summed before the shuffle), and handing it back is a join that adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import drop_stored, scratch, stored


def _least(links: DataFrame) -> DataFrame:
    """Smallest id around each node ``a``, itself included."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both, "star-both")
    least = stored(_least(both), "star-least")
    return (both.filter(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
                  "star-down")
    least = stored(_least(down), "star-least")
    joined = down.join(least, "a")
    # every smaller neighbour, and the node itself, hang on the smallest
    out = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of a set of links: how many there are and a sum of hashes."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link to another one; root is the smallest id."""
    edges = stored(links.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        with scratch(links.sparkSession):
            large = stored(_large_star(edges), "star-large")
            small = stored(_small_star(large), "star-small", outlive=True)
        now = _state(small)
        drop_stored(edges)
        edges = small
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
