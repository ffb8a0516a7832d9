"""Nearest neighbours by inner product through a hierarchical k-means tree."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.llm.workspace import Workspace

# Bounds of what the driver sees: vectors the tree is fitted on, queries it is calibrated with.
SAMPLE = 20_000
CALIBRATION_QUERIES = 100
BRANCHES = 8
LEAF_SAMPLE = 100
ROUNDS = 12
TARGET_RECALL = 0.97
# Vectors and queries that meet in one task at a time.
BLOCK = 4096
QUERY_BLOCK = 1024
# What two ways to add up a product may differ by, as a share of both lengths.
_ROUNDING = 1e-12


@dataclass
class Node:
    centres: np.ndarray | None = None
    children: list[int] = field(default_factory=list)
    leaf: int = -1


class Tree:
    """k-means in every inner node; queries walk it best bin first."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        self.nodes: list[Node] = []
        self.leaves = 0
        self._random = np.random.default_rng(seed)
        self._grow(sample)

    def _grow(self, points: np.ndarray) -> int:
        at = len(self.nodes)
        node = Node()
        self.nodes.append(node)
        centres, nearest = self._cluster(points)
        if centres is None:
            node.leaf = self.leaves
            self.leaves += 1
        else:
            node.centres = centres
            node.children = [self._grow(points[nearest == i]) for i in range(len(centres))]
        return at

    def _cluster(self, points: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
        """Centres with at least one point each; none if the points are few or all alike."""
        none = None, np.zeros(len(points), np.int64)
        if len(points) <= LEAF_SAMPLE:
            return none
        centres = points[self._random.choice(len(points), BRANCHES, replace=False)]
        for _ in range(ROUNDS):
            nearest = _nearest(points, centres)
            used = np.unique(nearest)
            centres = np.stack([points[nearest == i].mean(axis=0) for i in used])
        nearest = _nearest(points, centres)
        used, nearest = np.unique(nearest, return_inverse=True)
        return (centres[used], nearest) if len(used) > 1 else none

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point belongs to."""
        out = np.zeros(len(points), np.int64)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            at, rows = waiting.pop()
            node = self.nodes[at]
            if node.centres is None:
                out[rows] = node.leaf
                continue
            nearest = _nearest(points[rows], node.centres)
            waiting += [(child, rows[nearest == i]) for i, child in enumerate(node.children)]
        return out

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first: a queue holds the branches not taken, by inner product with their centre."""
        queue = [(0.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            node = self.nodes[at]
            if node.centres is None:
                yield node.leaf
                continue
            for score, child in zip((node.centres @ query).tolist(), node.children, strict=True):
                heapq.heappush(queue, (-score, child))


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)


def _matrix(column) -> np.ndarray:
    return np.array([list(v) for v in column], np.float64)


def best(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``queries``, ids and scores of the k largest inner products each, ties to the smaller id.

    A matrix product chooses; the scores are sums taken in one fixed order, so
    that a pair has the same score wherever it is computed.
    """
    rough = queries @ points.T
    if k < len(ids):
        # All that may tie with the k-th best, but for what a product can be off by.
        off = _ROUNDING * np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(points, axis=1).max()
        least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k, None] - off
        rows, near = np.nonzero(rough >= least)
    else:
        rows, near = np.nonzero(np.ones(rough.shape, bool))
    scores = (queries[rows] * points[near]).sum(axis=1)
    order = np.lexsort((ids[near], -scores, rows))
    rows, near, scores = rows[order], near[order], scores[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows, "left") < k
    return rows[first], ids[near][first], scores[first]


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """``vec, key, ids``: each different vector, its least id and its k + 1 least ids, all that an answer can name."""
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    least = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    grouped = least.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select("vec", F.col("ids")[0].alias("key"), "ids")


def _visits(work: Workspace, vectors: DataFrame, queries: DataFrame, tree, k: int, recall: float) -> int:
    """Widens the leaf visits until sampled queries find ``recall`` of their true neighbours."""
    asked = queries.orderBy(F.xxhash64("key")).limit(CALIBRATION_QUERIES).collect()
    matrix = _matrix(r["vec"] for r in asked)
    shared = work.spark.sparkContext.broadcast(matrix)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, ids = _matrix(batch.column(0).to_pylist()), batch.column(1).to_numpy()
            rows, found, scores = best(shared.value, points, ids, k)
            leaf = dict(zip(ids.tolist(), batch.column(2).to_pylist(), strict=True))
            yield pa.RecordBatch.from_pydict(
                {"query": rows, "key": found, "score": scores, "leaf": [leaf[i] for i in found.tolist()]}
            )

    near = vectors.select("vec", "key", "leaf").mapInArrow(exact, "query long, key long, score double, leaf long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    true = near.withColumn("place", place).where(F.col("place") <= k).select("query", "leaf").collect()
    steps = []
    for number, query in enumerate(matrix):
        step = {leaf: i for i, leaf in enumerate(tree.walk(query))}
        steps += [step[r["leaf"]] for r in true if r["query"] == number]
    # The least number of visits that finds so many: a quantile of the steps at which leaves come up.
    needed = np.sort(steps)[max(0, int(np.ceil(recall * len(steps))) - 1)] + 1 if steps else 1
    return int(min(needed, tree.leaves))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    recall: float = TARGET_RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product found for each query row.

    The tree is fitted on the ``SAMPLE`` different vectors of least hash; every
    vector is then put into its leaf. Queries visit leaves best bin first, as
    many as ``CALIBRATION_QUERIES`` of them need to find ``recall`` of their true
    neighbours: visits widen by one leaf at a time. Equal vectors are searched and scored once, with their k + 1
    least ids, so a hot vector is one row; leaves meet their queries in blocks
    of bounded size, so a hot leaf is many tasks.

    A query never finds its own id. Vectors that are null, zero, or hold a null
    or non-finite component take no part, nor do rows without an id or those of
    another length than the most common one. Repeated rows count once; ties go
    to the smaller id; with fewer than k candidates all are returned; an empty
    table gives an empty one; other columns are not read.
    """
    work = Workspace(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vec") == (size["n"] if size else 0)).distinct()
    distinct = work.store(_distinct(rows.select("vec_id", "vec"), k), "distinct")
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vec")
    asking = work.store(asking.join(distinct.select("vec", "key"), "vec"), "asking")
    queries = asking.select("key", "vec").dropDuplicates(["key"])

    # The tree is missing only if there is nothing to search.
    sample = distinct.orderBy(F.xxhash64("key")).limit(SAMPLE).select("vec").collect()
    tree = Tree(_matrix(r["vec"] for r in sample) if sample else np.zeros((0, 1)))
    shared = work.spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.assign(_matrix(batch.column("vec").to_pylist()))
            yield batch.append_column("leaf", pa.array(leaves)) if batch.num_rows else batch

    schema = "vec array<double>, key long, ids array<long>, leaf long"
    placed = work.store(distinct.mapInArrow(place, schema), "placed")
    visits = _visits(work, placed, queries, tree, k + 1, recall) if sample and not queries.isEmpty() else 1

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, keys = batch.column("vec").to_pylist(), batch.column("key").to_pylist()
            leaves = [[leaf for leaf, _ in zip(shared.value.walk(np.array(v)), range(visits))] for v in vecs]
            yield pa.RecordBatch.from_pydict({"vec": pa.array(vecs, pa.list_(pa.float64())), "key": keys, "leaf": pa.array(leaves, pa.list_(pa.int64()))})

    routed = queries.select("vec", "key").repartition("key").mapInArrow(route, "vec array<double>, key long, leaf array<long>")
    routed = work.store(routed.withColumn("leaf", F.explode("leaf")), "routed")

    # One row per leaf: the tree has at most SAMPLE of them.
    counts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    asked = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("query_blocks"))
    blocks = F.broadcast(counts.join(F.broadcast(asked), "leaf"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        own_block = F.pmod(F.xxhash64("key"), F.col(own)).alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return df.join(blocks, "leaf").select("leaf", "key", "vec", own_block, every)

    left = dealt(placed, "blocks", "query_blocks").groupBy("leaf", "blocks", "query_blocks")
    right = dealt(routed, "query_blocks", "blocks").groupBy("leaf", "blocks", "query_blocks")

    def meet(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(asked):
            return pd.DataFrame({"query": [], "key": [], "score": []})
        rows, found, scores = best(_matrix(asked["vec"]), _matrix(points["vec"]), points["key"].to_numpy(), k + 1)
        return pd.DataFrame({"query": asked["key"].to_numpy()[rows], "key": found, "score": scores})

    met = left.cogroup(right).applyInPandas(meet, "query long, key long, score double")
    place_ = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    kept = met.withColumn("place", place_).where(F.col("place") <= k + 1)
    named = work.store(kept.select("query", "key", "score"), "kept").join(placed.select("key", "ids"), "key")
    named = named.select("query", (-F.col("score")).alias("minus"), F.explode("ids").alias("vec_id"))
    lists = named.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("minus", "vec_id"))).alias("found"))
    lists = work.store(lists.select(F.col("query").alias("key"), F.slice("found", 1, k + 1).alias("found")), "lists")
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    answers = asking.select("query_id", "key").join(lists, "key").select("query_id", F.posexplode(F.slice(others, 1, k)))
    return answers.select(
        "query_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("col.vec_id").alias("vec_id"),
        (-F.col("col.minus")).alias("score"),
    )
