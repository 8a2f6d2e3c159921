"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.session import materialise

#: Far more rounds than the logarithm of any number of nodes; beyond it something is wrong.
MAX_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _towards_min(edges: DataFrame) -> DataFrame:
    """(node, other, least): each edge with the least neighbour of its first end, or that end itself.

    The minima are written, so that the join is one of two scans and the edges of a hub can be split.
    """
    least = edges.groupBy("node").agg(F.min("other").alias("least"))
    least = materialise(least.select("node", F.least("node", "least").alias("least")), "least")
    return edges.join(least, "node")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that ``edges`` (a, b: long, not NULL) name; the root is the least node of its component.

    Alternates between linking the larger neighbours of each node, and then its smaller ones, to the least node around it, until
    every edge leads to a root: at most a number of rounds in the order of the squared logarithm of the nodes, few in
    practice. Edges live in the shared folder; a round reads what the one before wrote, so a lost executor costs one
    round's tasks. Only a count and a checksum of the edges reach the driver.
    """
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
    )
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = now.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(
            now.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
        large = (
            _towards_min(both)
            .where("other > node")
            .select(F.col("other").alias("node"), F.col("least").alias("other"))
            .distinct()
        )
        small = _towards_min(materialise(large, "edges"))
        linked = small.select(F.col("other").alias("hi"), F.col("least").alias("lo")).union(
            small.select(F.col("node").alias("hi"), F.col("least").alias("lo"))
        )
        now = materialise(linked.where("hi <> lo").distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components do not settle")
    members = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return members.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
