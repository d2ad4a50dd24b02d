"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ramparts.llm.shared import Kept


def _towards_smallest(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(smallest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _towards_root(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    neighbours = edges.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return neighbours.unionByName(smallest.withColumnRenamed("m", "b")).filter(F.col("a") != F.col("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; root is the smallest node of the component.

    Alternates the two star contractions until the edge set stays as it is. A hub never meets in one task: its
    smallest neighbour is combined before the shuffle, and the join on it can be split by adaptive execution. Each
    round is a table in the shared folder, so a lost executor does not bring back earlier rounds. Self loops and
    nulls are ignored; no edges give no rows.
    """
    directed = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    kept = Kept(directed.filter(F.col("a") != F.col("b")).distinct(), "edges")
    state = _state(kept)
    while state[0]:
        contracted = Kept(_towards_root(_towards_smallest(kept.rows).distinct()).distinct(), "edges")
        kept.drop()
        kept, before, state = contracted, state, _state(contracted)
        if state == before:
            break
    return kept.rows.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(kept: Kept) -> tuple[int, int]:
    found = kept.rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return found[0], int(found[1] or 0)
