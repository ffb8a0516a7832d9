"""Bootstrap interval of a mean without copying rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Modulus of the hash family and the usual number of resamples.
PRIME = 2_147_483_647
RESAMPLES = 1000
QUANTILES = (0.025, 0.5, 0.975)
# Rows weighted at once in a task: bounds the matrix to ROWS x RESAMPLES.
ROWS_AT_ONCE = 1024


def resample_parameters(seed: int, resamples: int) -> list[tuple[int, int]]:
    """(a, b) of every resample, from the seed alone."""

    def number(part: str, r: int) -> int:
        return int(hashlib.md5(f"{part}:{seed}:{r}".encode()).hexdigest()[:15], 16)

    return [(number("a", r) % (PRIME - 1) + 1, number("b", r) % PRIME) for r in range(resamples)]


def poisson_limits() -> list[int]:
    """Hash values below entry k mean a Poisson(1) weight of at most k."""
    limits, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        limits.append(int(total * PRIME))
    return limits


def row_hash(key: str, seed: int):
    """31-bit hash of a row key; the same on any cluster."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % PRIME


def bootstrap_mean(
    rows: DataFrame,
    key: str,
    value: str,
    seed: int = 42,
    resamples: int = RESAMPLES,
) -> DataFrame:
    """One row (low, mid, high, mean) of the mean of ``value``.

    Each row enters each resample with a Poisson(1) weight. The weight is a
    function of row key, resample and seed, so partitioning does not matter. A
    task adds weights and weighted values per resample and emits one row per
    resample, and one numbered -1 in which every row weighs 1; no row is copied.
    """
    parameters = np.array(resample_parameters(seed, resamples), dtype=np.int64)
    limits = np.array(poisson_limits(), dtype=np.int64)

    def weigh(frames):
        weight = np.zeros(resamples, dtype=np.int64)
        total = np.zeros(resamples)
        rows_seen, plain_total = 0, 0.0
        for frame in frames:
            for start in range(0, len(frame), ROWS_AT_ONCE):
                part = frame.iloc[start : start + ROWS_AT_ONCE]
                hashed = part["hash"].to_numpy()[:, None]
                draw = (hashed * parameters[:, 0] + parameters[:, 1]) % PRIME
                w = np.searchsorted(limits, draw.ravel(), side="right").reshape(draw.shape)
                values = part["value"].to_numpy()
                weight += w.sum(axis=0)
                total += values @ w
                rows_seen += len(part)
                plain_total += values.sum()
        yield pd.DataFrame(
            {
                "resample": np.arange(-1, resamples),
                "weight": np.concatenate([[rows_seen], weight]),
                "total": np.concatenate([[plain_total], total]),
            }
        )

    hashed = rows.select(row_hash(key, seed).alias("hash"), F.col(value).cast("double").alias("value"))
    partial = hashed.mapInPandas(weigh, "resample int, weight long, total double")
    sums = partial.groupBy("resample").agg(F.sum("weight").alias("weight"), F.sum("total").alias("total"))
    means = sums.where(F.col("weight") > 0).select(
        "resample", (F.col("total") / F.col("weight")).alias("mean")
    )
    resampled = F.when(F.col("resample") >= 0, F.col("mean"))
    middle = F.percentile(resampled, F.array(*[F.lit(q) for q in QUANTILES]))
    plain = F.max(F.when(F.col("resample") < 0, F.col("mean")))
    return means.agg(middle.alias("q"), plain.alias("mean")).select(
        F.col("q")[0].alias("low"), F.col("q")[1].alias("mid"), F.col("q")[2].alias("high"), "mean"
    )
