"""Hard negatives by inner product through a multiway hyperplane tree with distance ranges."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from capstan.llm.workspace import Workspace

# Bound of what the driver sees: different vectors the tree is fitted on.
SAMPLE = 20_000
BRANCHES = 8
LEAF_SAMPLE = 256
# Vectors and anchors that meet in one task at a time.
BLOCK = 4096
QUERY_BLOCK = 512
# Components are whole units of 1 / SCALE.
SCALE = 256
# Doubles hold whole numbers up to here.
EXACT = float(1 << 53)
# Beyond all scores.
ANY = 1 << 62
NONE = -ANY
ROUTED_AT_ONCE = 256


@dataclass
class Node:
    """A leaf, or split points with, for points i and j, how far i is from the vectors below j."""

    points: np.ndarray | None = None
    heights: np.ndarray | None = None
    children: list[int] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    leaf: int = -1


class Tree:
    """Vectors lie below the nearest of a node's split points.

    Inner products become distances by one more coordinate, the height: with it
    every vector has the length ``radius``, and an anchor, at height 0, is the
    nearer to a vector the larger their inner product.
    """

    def __init__(self, sample: np.ndarray, radius: float, seed: int = 11):
        self.radius = radius
        # Distances are differences of squares: this much may be lost.
        self.slack = 1e-6 * radius
        self.nodes = [Node()]
        self.leaves = 0
        random = np.random.default_rng(seed)
        waiting = [(0, sample)]
        while waiting:
            at, vectors = waiting.pop()
            node = self.nodes[at]
            points = self._split_points(vectors, random) if len(vectors) > LEAF_SAMPLE else vectors[:0]
            if len(points) < 2:
                node.leaf = self.leaves
                self.leaves += 1
                continue
            node.points, node.heights = points, self._heights(points)
            nearest = self._distances(vectors, node).argmin(axis=1)
            for i in range(len(points)):
                node.children.append(len(self.nodes))
                self.nodes.append(Node())
                waiting.append((node.children[i], vectors[nearest == i]))
            node.low = np.full((len(points), len(points)), np.inf)
            node.high = -node.low

    def _heights(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.radius**2 - (vectors**2).sum(axis=1)))

    def _distances(self, vectors: np.ndarray, node: Node) -> np.ndarray:
        products = vectors @ node.points.T + np.outer(self._heights(vectors), node.heights)
        return np.sqrt(np.maximum(0.0, 2 * (self.radius**2 - products)))

    def _split_points(self, vectors: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """Up to ``BRANCHES`` of three times as many random vectors, each the farthest from those before."""
        some = vectors[random.choice(len(vectors), min(3 * BRANCHES, len(vectors)), replace=False)]
        near = self._distances(some, Node(some, self._heights(some)))
        chosen = [0]
        while len(chosen) < min(BRANCHES, len(some)):
            gap = near[:, chosen].min(axis=1)
            if gap.max() <= self.slack:
                break
            chosen.append(int(gap.argmax()))
        return some[chosen]

    def descend(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]]:
        """Each node some vectors reach: its number, their rows, distances to the split points and the nearest of these."""
        waiting = [(0, np.arange(len(vectors)))] if len(vectors) else []
        while waiting:
            at, rows = waiting.pop()
            node = self.nodes[at]
            if node.points is None:
                yield at, rows, None, None
                continue
            far = self._distances(vectors[rows], node)
            nearest = far.argmin(axis=1)
            yield at, rows, far, nearest
            waiting += [(node.children[i], rows[nearest == i]) for i in np.unique(nearest).tolist()]

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int64)
        for at, rows, far, _ in self.descend(vectors):
            if far is None:
                out[rows] = self.nodes[at].leaf
        return out

    def leaves_of(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``anchors`` and leaves that may hold a product with them from ``low`` to ``high``, a column a window.

        A window is an annulus around the anchor; a subtree goes if, for every
        window, the annulus around one of the split points that it implies
        misses the range of distances of that subtree. Windows with ``low``
        above ``high`` are none.
        """
        square = ((anchors**2).sum(axis=1) + self.radius**2)[:, None]
        inner = np.sqrt(np.maximum(0.0, square - 2 * high)) - self.slack
        outer = np.sqrt(np.maximum(0.0, square - 2 * low)) + self.slack
        is_window = low <= high
        rows, leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        waiting = [(0, np.nonzero(is_window.any(axis=1))[0])]
        while waiting:
            at, own = waiting.pop()
            node = self.nodes[at]
            if node.points is None:
                rows.append(own)
                leaves.append(np.full(len(own), node.leaf))
                continue
            far = np.sqrt(np.maximum(0.0, square[own] - 2 * (anchors[own] @ node.points.T)))[:, None, :]
            reach = outer[own][:, :, None]
            least = np.maximum(inner[own][:, :, None] - far, far - reach) - self.slack
            most = far + reach + self.slack
            meets = (node.low <= most[..., None]) & (node.high >= least[..., None])
            alive = (meets.all(axis=2) & is_window[own][:, :, None]).any(axis=1)
            waiting += [(c, own[alive[:, i]]) for i, c in enumerate(node.children) if alive[:, i].any()]
        return np.concatenate(rows), np.concatenate(leaves)


def _matrix(column) -> np.ndarray:
    return np.array([list(v) for v in column], np.float64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly, as 64-bit integers."""
    if len(left) and len(right):
        longest = max((left**2).sum(axis=1).max(), (right**2).sum(axis=1).max())
        if longest >= EXACT / 2:
            return left.astype(np.int64) @ right.astype(np.int64).T
    return (left @ right.T).astype(np.int64)


def units(vector: Column) -> Column:
    """``floor(256 * x)`` of each component; null where no score of the vector is sure to fit 64 bits."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    square = F.aggregate(whole, F.lit(0.0), lambda s, x: s + x * x)
    fits = F.forall(whole, lambda x: F.abs(x) < float(1 << 31)) & (square < float(1 << 62))
    return F.when(fits, F.transform(whole, lambda x: x.cast("int")))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite


def _ranked(rows: DataFrame, by: list[str], *order: Column | str) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def _grown(work: Workspace, sample: np.ndarray, classes: DataFrame, radius: float):
    """The tree of the sample and the table of all vectors with their leaves; its ranges are those of all vectors."""
    tree = Tree(sample, radius)
    shared = work.spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("leaf", pa.array(shared.value.assign(_matrix(batch.column("vec").to_pylist()))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {"node": [], "point": [], "child": [], "low": [], "high": []}
            for at, _, far, nearest in shared.value.descend(_matrix(batch.column(0).to_pylist())):
                for child in np.unique(nearest).tolist() if far is not None else []:
                    below = far[nearest == child]
                    made["node"] += [at] * below.shape[1]
                    made["point"] += range(below.shape[1])
                    made["child"] += [child] * below.shape[1]
                    made["low"] += below.min(axis=0).tolist()
                    made["high"] += below.max(axis=0).tolist()
            if made["node"]:
                yield pa.RecordBatch.from_pydict(made)

    columns = "label int, vec array<int>, key long, ids array<long>, leaf long"
    placed = work.store(classes.select("label", "vec", "key", "ids").mapInArrow(place, columns), "placed")
    kinds = "node long, point long, child long, low double, high double"
    ranges = placed.select("vec").mapInArrow(measure, kinds).groupBy("node", "point", "child")
    for r in ranges.agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        node = tree.nodes[r["node"]]
        node.low[r["point"], r["child"]], node.high[r["point"], r["child"]] = r["low"], r["high"]
    return tree, placed


def _first(
    anchors: np.ndarray, window: int, keys: np.ndarray, scores: np.ndarray, fits: np.ndarray, count: int
) -> pd.DataFrame:
    """Of the scores that fit, the ``count`` best of each row; ``keys`` rise, so ties go to the smaller."""
    row, at = np.nonzero(fits)
    order = np.lexsort((at, -scores[row, at], row))
    row, at = row[order], at[order]
    begins = np.searchsorted(row, row, "left")
    best = np.arange(len(row)) - begins < count
    row, at = row[best], at[best]
    return pd.DataFrame({"query": anchors[row], "window": window, "key": keys[at], "score": scores[row, at]})


def _met(work: Workspace, placed: DataFrame, routed: DataFrame, alike: bool, count: int) -> DataFrame:
    """The ``count`` best scores of each window of the anchors in each leaf, in blocks of bounded size."""
    schema = "query long, window long, key long, score long"
    # One row per leaf: the tree has at most SAMPLE of them.
    counts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    asked = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("query_blocks"))
    sizes = F.broadcast(counts.join(F.broadcast(asked), "leaf"))

    def dealt(rows: DataFrame, own: str, other: str):
        own_block = F.pmod(F.xxhash64("key"), F.col(own)).alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        columns = [c for c in rows.columns if c not in ("leaf", "ids")]
        return rows.join(sizes, "leaf").select("leaf", *columns, own_block, every).groupBy("leaf", "blocks", "query_blocks")

    def both(points: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(anchors):
            return pd.DataFrame({f.split()[0]: [] for f in schema.split(", ")})
        points = points.sort_values("key", ignore_index=True)
        scores = products(_matrix(anchors["vec"]), _matrix(points["vec"]))
        same = anchors["label"].to_numpy()[:, None] == points["label"].to_numpy()[None, :]
        made = []
        for window in range(anchors["low"].map(len).max()):
            low, high = (anchors[c].map(lambda x: x[window] if window < len(x) else NONE).to_numpy() for c in ("low", "high"))
            fits = (same if alike else ~same) & (scores >= low[:, None]) & (scores <= high[:, None]) & (low > NONE)[:, None]
            made.append(_first(anchors["key"].to_numpy(), window, points["key"].to_numpy(), scores, fits, count))
        return pd.concat(made)

    met = dealt(placed, "blocks", "query_blocks").cogroup(dealt(routed, "query_blocks", "blocks"))
    return met.applyInPandas(both, schema)


def _routed(queries: DataFrame, tree: Tree, sample: tuple, windows_of) -> DataFrame:
    """Each query, with the windows of scores it looks for, beside every leaf that these may reach.

    ``windows_of`` narrows windows by the exact scores of the sample: what lies
    below enough known ones need not be found.
    """
    shared = queries.sparkSession.sparkContext.broadcast((tree, *sample))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, vectors, labels = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROUTED_AT_ONCE):
                some = batch.slice(start, ROUTED_AT_ONCE)
                rows = some.to_pylist()
                anchors = _matrix(r["vec"] for r in rows)
                found = [windows_of(r, s, labels) for r, s in zip(rows, products(anchors, vectors), strict=True)]
                widest = max(len(w) for w in found)
                padded = np.array([w + [(1, 0)] * (widest - len(w)) for w in found], np.float64)
                reached, leaves = grown.leaves_of(anchors, padded[..., 0], padded[..., 1])
                columns = {c: some.column(c).take(pa.array(reached)) for c in ("key", "label", "vec")}
                for i, name in enumerate(("low", "high")):
                    values = pa.array([[w[i] for w in f] for f in found], pa.list_(pa.int64()))
                    columns[name] = values.take(pa.array(reached))
                yield pa.RecordBatch.from_pydict(columns | {"leaf": pa.array(leaves)})

    schema = "key long, label int, vec array<int>, low array<long>, high array<long>, leaf long"
    return queries.repartition("key").mapInArrow(route, schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, exactly.

    Components count in whole units of 1/256. An anchor's positives are the
    ``positives`` other rows of its label with the largest inner product; the
    negatives of each are the first ``negatives`` rows of another label whose
    product is ``least_percent`` to ``most_percent`` percent of the positive's.
    Ties go to the smaller id; with fewer rows all are returned; an anchor
    without positives, or a positive without such negatives, has no row.

    The tree is fitted on the ``SAMPLE`` different vectors of least hash, every
    vector is put into its leaf, and the distance ranges are those of all
    vectors. Windows, narrowed by the exact scores of the sample, become annuli;
    leaves that their ranges leave over meet the anchors in blocks of bounded
    size and are scored wholly, so nothing is missed. Equal vectors of a label
    are searched and scored once, with as many of their least ids as an answer
    can name.

    Rows with a null id, label or vector, with a null or non-finite component,
    with another length than the most common one, or so large (2**31 units, or
    a squared length of 2**62) that a score may not fit 64 bits take no part. An
    id that repeats counts once, with its least label and vector. An empty
    table gives an empty one; other columns are not read.
    """
    work = Workspace(vectors.sparkSession)
    id_, label = F.col(f"`{id_col}`").cast("long"), F.col(f"`{label_col}`").cast("int")
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(
        id_.alias("vec_id"), label.alias("label"), vector.alias("real"), F.coalesce(is_anchor, F.lit(False)).alias("asks")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("real")))
    rows = rows.select("vec_id", "label", units(F.col("real")).alias("vec"), "asks").where("vec IS NOT NULL")
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vec") == (size["n"] if size else 0))
    rows = work.store(_ranked(rows, ["vec_id"], "label", "vec").where("place = 1").drop("place"), "rows")

    # An answer names at most this many ids of one class, the anchor's own not counted.
    most = max(positives + 1, negatives)
    least = _ranked(rows.select("vec_id", "label", "vec"), ["label", "vec"], "vec_id").where(F.col("place") <= most)
    classes = least.groupBy("label", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = work.store(classes.select("label", "vec", F.col("ids")[0].alias("key"), "ids"), "classes")
    asking = rows.where("asks").select(F.col("vec_id").alias("anchor_id"), "label", "vec")
    asking = work.store(asking.join(classes.select("label", "vec", "key"), ["label", "vec"]), "asking")
    queries = asking.select("key", "label", "vec").dropDuplicates(["key"])

    sample = classes.orderBy(F.xxhash64("key")).limit(SAMPLE).select("vec", "label").collect()
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    radius = float(np.sqrt(classes.agg(F.max(square)).first()[0] or 0.0)) * (1 + 1e-12)
    points = _matrix(r["vec"] for r in sample) if sample else np.zeros((0, 1))
    kinds = np.array([r["label"] for r in sample], np.int64)
    tree, placed = _grown(work, points, classes, radius)

    def above(row: dict, scores: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
        """From the score that enough vectors beside the anchor's own are known to have."""
        own = scores[labels == row["label"]]
        known = np.partition(own, -(positives + 2))[-(positives + 2)] if len(own) > positives + 1 else 1 - ANY
        return [(int(known), ANY)]

    def named(met: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
        """The best ``n`` ids of each of ``by`` with their scores: of classes first, then of their ids."""
        met = _ranked(met, by, F.desc("score"), "key").where(F.col("place") <= n).drop("place")
        ids = work.store(met, name).join(placed.select("key", "ids"), "key").select(*by, "score", F.explode("ids").alias("vec_id"))
        return work.store(_ranked(ids, by, F.desc("score"), "vec_id").where(F.col("place") <= n), f"{name}-named")

    routed = work.store(_routed(queries, tree, (points, kinds), above), "routed")
    near = named(_met(work, placed, routed, True, positives + 1), ["query"], positives + 1, "near")

    # What a positive's score allows; anchors of one class share their windows.
    low = F.ceil(F.col("score").cast("decimal(24,0)") * least_percent / 100).cast("long")
    high = F.floor(F.col("score").cast("decimal(24,0)") * most_percent / 100).cast("long")
    windows = near.select("query", "score", low.alias("low"), high.alias("high")).where("low <= high").distinct()
    windows = windows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "low", "high"))).alias("windows"))
    asked = queries.join(windows.withColumnRenamed("query", "key"), "key")

    def within(row: dict, scores: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
        """From the score that enough vectors of other labels inside the window are known to have."""
        others, made = np.sort(scores[labels != row["label"]]), []
        for w in row["windows"]:
            known = np.searchsorted(others, w["high"], "right") - negatives
            made.append((max(w["low"], int(others[known])) if known >= 0 else w["low"], w["high"]))
        return made

    routed = work.store(_routed(asked, tree, (points, kinds), within), "routed")
    hard = named(_met(work, placed, routed, False, negatives), ["query", "window"], negatives, "hard")
    score_of = F.posexplode(F.transform("windows", lambda w: w["score"])).alias("window", "positive_score")
    by_window = asked.select(F.col("key").alias("query"), score_of)
    hard = hard.join(by_window.withColumn("window", F.col("window").cast("long")), ["query", "window"])

    found = asking.select("anchor_id", F.col("key").alias("query")).join(near, "query").where("vec_id <> anchor_id")
    found = _ranked(found.drop("place"), ["anchor_id"], F.desc("score"), "vec_id").where(F.col("place") <= positives)
    found = found.select("anchor_id", "query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(hard, ["query", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
