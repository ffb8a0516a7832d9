"""Batch inference with a model that each Python worker loads once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.functions.labels import IGNORED

Predictor = Callable[[np.ndarray], np.ndarray]

SCORED = T.StructType(
    [T.StructField("predicted", T.IntegerType()), T.StructField("loss", T.DoubleType())]
)


def linear_predictor(path: str) -> Callable[[], Predictor]:
    """A factory that loads ``weight`` and ``bias`` from an .npz file."""

    def load() -> Predictor:
        arrays = np.load(path)
        weight, bias = arrays["weight"], arrays["bias"]
        return lambda features: features @ weight + bias

    return load


def score_udf(make_predictor: Callable[[], Predictor], width: int, batch_size: int = 32):
    """UDF (features, label) -> struct(predicted, loss) over fixed-size batches."""

    def load():
        predict = make_predictor()

        def forward(features: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
            logits = predict(features).astype(np.float64)
            top = logits.max(axis=1, keepdims=True)
            mass = np.log(np.exp(logits - top).sum(axis=1)) + top[:, 0]
            label = labels.astype(np.int64).ravel()
            counted = label != IGNORED
            chosen = logits[np.arange(len(label)), np.where(counted, label, 0)]
            return {
                "predicted": logits.argmax(axis=1).astype(np.int32),
                "loss": np.where(counted, mass - chosen, 0.0),
            }

        return forward

    return predict_batch_udf(
        load, return_type=SCORED, batch_size=batch_size, input_tensor_shapes=[[width], [1]]
    )


def score_rows(
    df: DataFrame,
    make_predictor: Callable[[], Predictor],
    width: int,
    features: str = "features",
    label: str = "label",
    batch_size: int = 32,
) -> DataFrame:
    """Add ``predicted`` and ``loss``; works on batch and streaming frames."""
    score = score_udf(make_predictor, width, batch_size)
    # Both fields come from one struct column, so the model runs once per row.
    scored = df.withColumn("__scored", score(features, F.array(F.col(label).cast("int"))))
    return scored.select(
        *df.columns, F.col("__scored.predicted").alias("predicted"), F.col("__scored.loss").alias("loss")
    )


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: str | T.StructType,
    columns: list[str] | None = None,
    batch_size: int | None = None,
) -> DataFrame:
    """User function over batches: dict of lists in, dict of lists out.

    ``columns`` are the inputs the function reads; Spark cannot see into it, so
    all other columns are dropped before the rows leave the JVM. ``batch_size``
    is the size of every batch but the last of a partition, which may be smaller
    and is kept; without it batches are as Spark cuts them.
    """

    def sized(frames):
        rest = None
        for frame in frames:
            rows = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            whole = len(rows) - len(rows) % batch_size
            for start in range(0, whole, batch_size):
                yield rows.iloc[start : start + batch_size]
            rest = rows.iloc[whole:]
        if rest is not None and len(rest):
            yield rest

    def apply(frames):
        for frame in sized(frames) if batch_size else frames:
            yield pd.DataFrame(fn({name: frame[name].tolist() for name in frame.columns}))

    return df.select(*(columns or df.columns)).mapInPandas(apply, schema)


def argmax(values: Column | str) -> Column:
    """0-based position of the first largest entry."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
