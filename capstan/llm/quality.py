"""Quality of documents by ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from capstan.llm.texts import documents_of, per_batch
from capstan.session import ship_package

# Bound of the rated documents the model is fitted on: those of least hashed id.
SAMPLE = 12_000
BUCKETS = 1 << 18
# A document stays if the highest grade is at least this likely.
LEAST = 0.5
ROUNDS = 200
STEP = 0.5
# Pulls weights of words that few rated documents hold to zero.
SPARSITY = 2e-4
# A share of one counts as much as this many words; shares are of this many more words than there are.
SHARE_SCALE = 8.0
FEW_WORDS = 10
CACHE_ENTRIES = 300_000
# Features of the sample that a step of the fit looks at together.
AT_ONCE = 1 << 19
_WORD = re.compile(r"[\W_]+")
# Longer tokens count piece by piece, and by their runs of so many characters.
LONGEST = 64
RUN = 4


def _bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode(), 0) % BUCKETS


def shape(token: str) -> str:
    """Runs of letters by case, digits as 9, anything else as it stands, each run once."""
    out = []
    for c in token:
        kind = unicodedata.category(c)
        mark = "A" if kind == "Lu" else "a" if kind[0] == "L" else "9" if kind[0] == "N" else c
        if not out or out[-1] != mark:
            out.append(mark)
    return "".join(out)


def marks(token: str) -> str:
    """What a token has beside letters and digits, each run once."""
    return "".join(c for c in shape(token) if c not in "Aa9")


class Features:
    """Hashed features of a text: which words and marks it has, which share of the words has which shape and marks.

    Shares lean to zero in texts of few words. A token of more than ``LONGEST``
    characters, as of a script without spaces, stands for its consecutive pieces,
    and every run of ``RUN`` characters in it is a word, so all of it counts.
    """

    def __init__(self) -> None:
        self._cache: dict[str, tuple[int, int, int, int]] = {}
        self._repeat = _bucket("repeat")

    def _parts(self, token: str) -> tuple[int, int, int, int]:
        found = self._cache.get(token)
        if found is None:
            if len(self._cache) > CACHE_ENTRIES:
                self._cache.clear()
            word = _WORD.sub("", token).lower()
            beside = marks(token)
            names = ("w " + word, "m " + beside, "s " + shape(token), "n " + beside)
            found = self._cache[token] = tuple(map(_bucket, names))
        return found

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Bucket numbers and values; nothing for a text without words."""
        tokens, runs = text.split(), np.zeros(0, np.int32)
        if not tokens:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        if max(map(len, tokens)) > LONGEST:
            long = [t.lower() for t in tokens if len(t) > LONGEST]
            found = {t[i : i + RUN] for t in long for i in range(len(t) - RUN + 1)}
            runs = np.array([_bucket("r " + run) for run in found], np.int32)
            tokens = [t[i : i + LONGEST] for t in tokens for i in range(0, len(t), LONGEST)]
        both = np.array([self._parts(t) for t in tokens], np.int32)
        words = np.unique(np.append(both[:, :2], runs))
        shapes, counts = np.unique(both[:, 2:], return_counts=True)
        repeats = sum(map(str.__eq__, tokens, tokens[1:]))
        buckets = np.concatenate([words, shapes, [self._repeat]]).astype(np.int32)
        shares = np.append(counts, repeats) * (SHARE_SCALE / (len(tokens) + FEW_WORDS))
        return buckets, np.concatenate([np.ones(len(words)), shares]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Ordinal:
    """P(grade > k) = sigmoid(w.x - threshold k), with one weight vector and rising thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def above(self, buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k below the highest grade."""
        return _sigmoid(self.weights[buckets] @ values - self.thresholds)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, highest: int) -> Ordinal:
    """See ``fitted``; rows are (buckets, values) of each document."""
    if not len(rows):
        return fitted(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.int64), grades, highest)
    buckets, values = (np.concatenate([row[side] for row in rows]) for side in (0, 1))
    return fitted(buckets, values, np.array([len(b) for b, _ in rows]), grades, highest)


def _chunks(sizes: np.ndarray) -> list[tuple[slice, slice, np.ndarray]]:
    """Runs of documents with about ``AT_ONCE`` features: the documents, their features, and whose each feature is."""
    ends = np.append(0, np.cumsum(sizes))
    cuts = np.append(np.nonzero(np.diff(ends[:-1] // AT_ONCE))[0] + 1, len(sizes)).tolist()
    starts = [0, *cuts[:-1]]
    return [
        (slice(a, b), slice(int(ends[a]), int(ends[b])), np.repeat(np.arange(b - a, dtype=np.int32), sizes[a:b]))
        for a, b in zip(starts, cuts, strict=True)
        if b > a
    ]


def fitted(buckets: np.ndarray, values: np.ndarray, sizes: np.ndarray, grades: np.ndarray, highest: int) -> Ordinal:
    """Proximal AdaGrad on the cumulative-link likelihood; thresholds move by the logs of their gaps.

    ``buckets`` and ``values`` hold the features of all documents, ``sizes`` how
    many each has. Without documents every probability is near one: nothing is
    known against a text. Features are gone through some documents at a time, so
    beside themselves they need little memory.
    """
    if not len(sizes):
        return Ordinal(np.zeros(BUCKETS), np.arange(highest) - 20.0)
    chunks = _chunks(sizes)
    n = len(sizes)
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    # Start at the grades' own shares; a grade nobody gave keeps a small one.
    shares = np.array([(grades <= k).sum() + 0.5 for k in range(highest)]) / (n + 1)
    cuts = np.log(shares / (1 - shares))
    place = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    place_squares = np.full(highest, 1e-8)
    for _ in range(ROUNDS):
        thresholds = np.cumsum(np.concatenate([place[:1], np.exp(place[1:])]))
        score = np.concatenate(
            [np.bincount(owner, weights[buckets[own]] * values[own], d.stop - d.start) for d, own, owner in chunks]
        )
        # Cumulative probabilities with the open ends, and their slopes.
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        upper, lower = edges[grades + 1] - score, edges[grades] - score
        p_upper, p_lower = _sigmoid(upper), _sigmoid(lower)
        d_upper = np.where(np.isinf(upper), 0, p_upper * (1 - p_upper))
        d_lower = np.where(np.isinf(lower), 0, p_lower * (1 - p_lower))
        mass = np.maximum(p_upper - p_lower, 1e-12)
        by_score = (d_upper - d_lower) / mass / n
        gradient = np.zeros(BUCKETS)
        for documents, own, owner in chunks:
            gradient += np.bincount(buckets[own], by_score[documents][owner] * values[own], BUCKETS)
        squares += gradient**2
        rate = STEP / np.sqrt(squares)
        moved = weights - rate * gradient
        weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * SPARSITY, 0)
        by_cut = np.bincount(grades, -d_upper / mass / n, highest + 1)[:highest]
        by_cut += np.bincount(grades, d_lower / mass / n, highest + 1)[1:]
        by_place = np.cumsum(by_cut[::-1])[::-1]
        by_place[1:] *= np.exp(place[1:])
        place_squares += by_place**2
        place = place - 0.1 * by_place / np.sqrt(place_squares)
    return Ordinal(weights, np.cumsum(np.concatenate([place[:1], np.exp(place[1:])])))


def train(docs: DataFrame, ratings: DataFrame, highest: int, sample: int = SAMPLE) -> Ordinal:
    """Fits on at most ``sample`` rated documents: ``ratings`` has ``doc_id, grade`` with grades 0..highest.

    Ratings with a null id or grade count for nothing; of several for one
    document the lowest holds, and of several texts of one id that of least hash.
    The sample bounds what is broadcast and what reaches the driver, whatever the
    tables hold.
    """
    ship_package(docs.sparkSession)
    real = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    picked = real.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    if not picked:
        return fit([], np.zeros(0, np.int64), highest)
    chosen = docs.sparkSession.createDataFrame(picked, "doc_id long, grade int")
    texts = docs.join(F.broadcast(chosen), "doc_id")
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    texts = texts.withColumn("one", one).where("one = 1").select("text", "grade")

    def make() -> Callable:
        features = Features()

        def run(some: list[str], grades: list[int]) -> dict:
            made = [features(t) for t in some]
            return {"buckets": [b.tobytes() for b, _ in made], "values": [v.tobytes() for _, v in made], "grade": grades}

        return run

    rows = per_batch(texts, make, "buckets binary, values binary, grade int").collect()
    rows.sort(key=lambda r: (r["grade"], bytes(r["buckets"]), bytes(r["values"])))
    if not rows:
        return fit([], np.zeros(0, np.int64), highest)
    buckets = np.concatenate([np.frombuffer(r["buckets"], np.int32) for r in rows])
    values = np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows])
    sizes = np.array([len(r["buckets"]) // 4 for r in rows])
    grades = np.array([r["grade"] for r in rows], np.int64)
    # The rows themselves are as large again.
    del rows
    return fitted(buckets, values, sizes, grades, highest)


def grade_of_labels(labels: DataFrame) -> DataFrame:
    """Graded ratings from two marks: 0 toxic, 1 of low quality, 2 neither; null marks count as unrated."""
    toxic, quality = F.col("toxic"), F.col("quality")
    grade = F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade"))


def with_quality(
    docs: DataFrame,
    ratings: DataFrame,
    highest: int = 2,
    least: float = LEAST,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``expected_grade, p_top, keep``.

    ``p_top`` is the probability of the highest grade; a document is kept if it
    reaches ``least``. Whole texts are scored; a null text counts as empty and a
    text without words is scored by the thresholds alone. Rows without an id are
    scored like any other, repeated rows alike; an empty table gives an empty
    one; columns that already have one of the three names are replaced. No
    shuffle of texts.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(documents_of(docs, id_col, text_col), ratings, highest, sample))
    added = ("expected_grade", "p_top", "keep")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("expected_grade double, p_top double, keep boolean")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            above = np.zeros((batch.num_rows, highest))
            for i, text in enumerate(batch.column(text_col)):
                above[i] = model.value.above(*features(text.as_py() or ""))
            made = (above.sum(axis=1), above[:, -1], above[:, -1] >= least)
            for name, values in zip(added, made, strict=True):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    return rows.mapInArrow(run, schema)


def quality(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, expected_grade, p_top, keep`` of every row with an id; see ``with_quality``."""
    return with_quality(documents_of(docs, id_col, text_col), ratings, **settings).drop("text")
