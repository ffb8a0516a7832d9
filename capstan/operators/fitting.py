"""Small models fitted by one pass of sums, kept as a file that travels with the tasks."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.operators.model_search import Model
from capstan.operators.scoring import Predictor

# Largest vocabulary of a fitted caption model: its table of neighbours reaches the driver.
MOST_TOKENS = 1024


def ship_arrays(spark: SparkSession, **arrays: np.ndarray) -> str:
    """Save arrays to a file that Spark hands to every executor; its name there."""
    path = os.path.join(tempfile.mkdtemp(prefix="capstan-model-"), f"model-{uuid.uuid4().hex}.npz")
    np.savez(path, **arrays)
    return ship_file(spark, path)


def ship_file(spark: SparkSession, path: str) -> str:
    """Hand a file of any file system that Spark reads to every executor; its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def save_model(name: str, path: str) -> None:
    """Keep a shipped model as a file of the driver's, for later runs."""
    shutil.copyfile(SparkFiles.get(name), path)


def shipped_arrays(name: str) -> dict[str, np.ndarray]:
    with np.load(SparkFiles.get(name)) as file:
        return {key: file[key] for key in file.files}


def fit_centres(rows: DataFrame, width: int, features: str = "features", label: str = "label") -> str:
    """A linear predictor of labels 0..n-1: the nearest mean vector of a label's rows, as a shipped file.

    A label's score is ``2 c.x - c.c`` for its mean c, the negative squared
    distance but for a term that all labels share. Labels without rows get no
    score; rows without label are not looked at. One partial aggregation; n rows
    reach the driver.
    """
    means = [F.avg(F.get(features, F.lit(i)).cast("double")).alias(f"m{i}") for i in range(width)]
    found = rows.where(F.col(label).isNotNull()).groupBy(label).agg(*means).collect()
    count = max((r[label] for r in found), default=-1) + 1
    weight, bias = np.zeros((width, count)), np.full(count, -np.inf)
    for r in found:
        centre = np.array([r[f"m{i}"] for i in range(width)])
        weight[:, r[label]], bias[r[label]] = 2 * centre, -(centre**2).sum()
    return ship_arrays(rows.sparkSession, weight=weight, bias=bias)


def linear_model(name: str) -> Callable[[], Predictor]:
    """A factory of the predictor in a shipped file."""

    def load() -> Predictor:
        arrays = shipped_arrays(name)
        return lambda features: features.astype(np.float64) @ arrays["weight"] + arrays["bias"]

    return load


def fit_captions(rows: DataFrame, size: int, features: str = "features", ids: str = "ids") -> str:
    """A next-token model of captions and pictures, as a shipped file.

    The score of a token is the logarithm of one more than how often it follows
    the last one, plus the product of the picture's features with the mean
    features of the pictures the token stands beside. ``rows`` holds features
    and token ids in 0..size-1, from start to end mark. Tasks add up their rows,
    so a frequent token is one row per task; at most ``size`` x (``size`` +
    width) sums reach the driver.
    """
    if size > MOST_TOKENS:
        raise ValueError(f"at most {MOST_TOKENS} tokens, not {size}")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, seen, sums = np.zeros((size, size)), np.zeros(size), None
        for batch in batches:
            for vector, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = np.array(tokens, np.int64)
                np.add.at(pairs, (tokens[:-1], tokens[1:]), 1)
                sums = np.zeros((size, len(vector))) if sums is None else sums
                np.add.at(sums, tokens, np.array(vector, np.float64))
                np.add.at(seen, tokens, 1)
        if sums is not None:
            for kind, table in (("pairs", pairs), ("sums", sums), ("seen", seen[:, None])):
                i, j = np.nonzero(table)
                if len(i):
                    yield pa.RecordBatch.from_pydict({"kind": [kind] * len(i), "i": i, "j": j, "value": table[i, j]})

    parts = rows.select(features, ids).mapInArrow(add, "kind string, i long, j long, value double")
    tables = {"pairs": np.zeros((size, size)), "seen": np.zeros((size, 1))}
    found = parts.groupBy("kind", "i", "j").agg(F.sum("value").alias("value")).collect()
    width = max((r["j"] for r in found if r["kind"] == "sums"), default=-1) + 1
    tables["sums"] = np.zeros((size, width))
    for r in found:
        tables[r["kind"]][r["i"], r["j"]] = r["value"]
    centres = tables["sums"] / np.maximum(1, tables["seen"])
    return ship_arrays(rows.sparkSession, follows=np.log(tables["pairs"] + 1), centres=centres)


def caption_model(name: str) -> Callable[[], Model]:
    """A factory of the model in a shipped file."""

    def load() -> Model:
        arrays = shipped_arrays(name)

        def scores(features: np.ndarray, sequences: list[np.ndarray]) -> np.ndarray:
            last = np.array([s[-1] for s in sequences])
            return arrays["follows"][last] + features @ arrays["centres"].T

        return scores

    return load
