"""Connected components by alternating stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.workspace import Workspace


def _state(edges: DataFrame) -> tuple:
    """Size and an order-free fingerprint of an edge table: two numbers reach the driver."""
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mark).first())


def _stars(work: Workspace, edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each edge beside the least id near its ``u``.

    Both sides come from written tables, so the join shuffles both and adaptive
    execution splits the edges of a hub.
    """
    return edges.join(work.store(least, "least").hint("merge"), "u")


def connected_components(work: Workspace, links: DataFrame) -> DataFrame:
    """``node, component`` for every id in ``links`` (``a, b``), component being the least id it reaches.

    Alternates large stars (a node hands its larger neighbours to the least one)
    and small stars (a node hands its smaller neighbours to the least one) until
    nothing moves: about log2(n) rounds. Links may repeat, in any direction;
    null ends and self links are passed over. An empty table gives an empty one.
    Minima are combined before each shuffle, so a hub costs no large group.
    """
    real = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = work.store(
        real.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: u > v holds for what is left, the least id being on the right.
        large = _stars(work, both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = work.store(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _stars(work, large, least)
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = work.store(small.select("e.*").where("u <> v").distinct(), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return work.store(nodes.unionByName(roots), "components")
