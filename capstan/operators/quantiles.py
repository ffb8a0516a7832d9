"""Percentiles from sketches that add up over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a KLL sketch (Karnin, Lang, Liberty 2016), and how far the rank of a
# quantile from it may be off, as a share of all values: 99 of 100 quantiles are
# within about 0.007; the bound is twice that.
K = 400
RANK_ERROR = 0.015
QUANTILES = (0.5, 0.95, 0.99)


def length_state(lengths: DataFrame, max_length: int, group_cols: list[str] = (), value: str = "length") -> DataFrame:
    """A row per group that adds up: counts, sums, extremes and a sketch of the values."""
    column = F.col(value).cast("long")
    return lengths.where(column.isNotNull()).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(column).alias("min_length"),
        F.max(column).alias("max_length"),
        F.sum(column).alias("sum_length"),
        F.sum((column > max_length).cast("long")).alias("n_over"),
        F.kll_sketch_agg_bigint(column, F.lit(K)).alias("sketch"),
    )


def merge_length_states(states: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """States of disjoint batches as one per group."""
    return states.groupBy(*group_cols).agg(
        F.sum("n").alias("n"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.sum("sum_length").alias("sum_length"),
        F.sum("n_over").alias("n_over"),
        F.kll_merge_agg_bigint("sketch", F.lit(K)).alias("sketch"),
    )


def finish_lengths(state: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """n, min, max, mean, percentiles (p50, p95, p99) and the share over the limit.

    A percentile is a value whose rank is off by at most ``RANK_ERROR`` of all.
    """

    def quantile(q: float) -> Column:
        return F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{round(100 * q)}")

    return state.select(
        *group_cols,
        "n",
        "min_length",
        "max_length",
        (F.col("sum_length") / F.col("n")).alias("avg_length"),
        *[quantile(q) for q in QUANTILES],
        (F.col("n_over") / F.col("n")).alias("share_over"),
    )


def rank_errors(lengths: DataFrame, profile: DataFrame, value: str = "length") -> DataFrame:
    """How far the profile's percentiles are from their rank, as shares of all values.

    A value that repeats holds all ranks of its copies.
    """
    names = [(q, f"p{round(100 * q)}") for q in QUANTILES]
    counted = lengths.crossJoin(F.broadcast(profile.limit(1).select(*[n for _, n in names]))).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((F.col(value) < F.col(n)).cast("long")).alias(f"below_{n}") for _, n in names],
        *[F.sum((F.col(value) <= F.col(n)).cast("long")).alias(f"until_{n}") for _, n in names],
    )

    def off(q: float, name: str) -> Column:
        low, high = F.col(f"below_{name}") / F.col("n"), F.col(f"until_{name}") / F.col("n")
        return F.greatest(low - q, q - high, F.lit(0.0)).alias(f"off_{name}")

    return counted.select(*[off(q, n) for q, n in names])
