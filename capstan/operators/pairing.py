"""Predictions and references brought together by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_by(df: DataFrame, key: str = "id") -> DataFrame:
    """The same rows; a key that occurs twice fails the job.

    Groups by the key a following join uses, so the rows move only once.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others])
    message = F.concat(F.lit("duplicate key: "), F.col(key).cast("string"))
    single = F.when(F.col("__n") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return grouped.where(single).select(key, *others)


def pair_by_key(predictions: DataFrame, references: DataFrame, key: str = "id", unmatched: str = "fail") -> DataFrame:
    """(key, prediction, ...) beside (key, reference, ...).

    A key that only one side has fails the job; with ``unmatched="drop"`` such
    rows are left out, for sides that are not meant to cover each other.
    """
    left, right = unique_by(predictions, key), unique_by(references, key)
    if unmatched == "drop":
        return left.join(right, key)
    if unmatched != "fail":
        raise ValueError(f"unmatched is fail or drop, not {unmatched}")
    both = left.withColumn("__left", F.lit(True)).join(right.withColumn("__right", F.lit(True)), key, "full")
    side = F.when(F.col("__left").isNull(), "prediction").otherwise("reference")
    message = F.concat(F.lit("no "), side, F.lit(" for key: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    complete = F.col("__left").isNotNull() & F.col("__right").isNotNull()
    checked = F.when(complete, True).otherwise(F.raise_error(message).cast("boolean"))
    return both.where(checked).drop("__left", "__right")
