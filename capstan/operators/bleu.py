"""Corpus BLEU from additive sums (Papineni et al. 2002, Post 2018)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.operators.ngrams import MAX_ORDER, overlap

# Fixed value: numerator of a precision without any match ("floor" smoothing).
SMOOTH_VALUE = 0.1

STATE = [f"{what}_{n}" for n in range(1, MAX_ORDER + 1) for what in ("correct", "total")]
STATE += ["sys_len", "ref_len", "n_pairs"]


def bleu_state(pairs: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Additive sums per group: correct_n, total_n, sys_len, ref_len, n_pairs."""
    long = overlap(pairs, group_cols)

    def total(n: int, what: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("n") == n, F.col(what))), F.lit(0))

    sums = []
    for n in range(1, MAX_ORDER + 1):
        sums += [total(n, "matches").alias(f"correct_{n}"), total(n, "predicted").alias(f"total_{n}")]
    sums += [
        total(1, "predicted").alias("sys_len"),
        total(1, "expected").alias("ref_len"),
        total(0, "matches").alias("n_pairs"),
    ]
    return long.groupBy(*group_cols).agg(*sums)


def merge_states(states: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Sum states of batches that share no pair."""
    return states.groupBy(*group_cols).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in STATE]
    )


def finish_bleu(
    state: DataFrame,
    group_cols: list[str] = (),
    smooth_value: float = SMOOTH_VALUE,
    more: list[Column] = (),
) -> DataFrame:
    """score 0..100, counts, totals, precisions, bp, sys_len, ref_len per group.

    ``more`` are further columns to take along from the state.
    """
    orders = range(1, MAX_ORDER + 1)
    correct = [F.col(f"correct_{n}") for n in orders]
    total = [F.col(f"total_{n}") for n in orders]
    no_match = sum(correct[1:], correct[0]) == 0

    def precision(c: Column, t: Column) -> Column:
        smoothed = F.when(c == 0, smooth_value).otherwise(c)
        return F.when(no_match | (t == 0), 0.0).otherwise(100.0 * smoothed / t)

    precisions = [precision(c, t) for c, t in zip(correct, total)]
    bp = (
        F.when(F.col("sys_len") >= F.col("ref_len"), 1.0)
        .when(F.col("sys_len") == 0, 0.0)
        .otherwise(F.exp(1.0 - F.col("ref_len") / F.col("sys_len")))
    )
    with_parts = state.select(
        *group_cols,
        F.array(*correct).alias("counts"),
        F.array(*total).alias("totals"),
        F.array(*precisions).alias("precisions"),
        bp.alias("bp"),
        "sys_len",
        "ref_len",
        *more,
    )
    mean_log = F.aggregate("precisions", F.lit(0.0), lambda a, p: a + F.log(p)) / MAX_ORDER
    score = F.when(F.array_min("precisions") == 0, 0.0).otherwise(F.col("bp") * F.exp(mean_log))
    parts = [c for c in with_parts.columns if c not in group_cols]
    return with_parts.select(*group_cols, score.alias("score"), *parts)


def bleu(pairs: DataFrame, group_cols: list[str] = (), smooth_value: float = SMOOTH_VALUE) -> DataFrame:
    return finish_bleu(bleu_state(pairs, group_cols), group_cols, smooth_value)


def ratio_form(finished: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """The same result as fractions of one with the length ratio."""
    ratio = F.when(F.col("ref_len") > 0, F.col("sys_len") / F.col("ref_len")).otherwise(0.0)
    return finished.select(
        *group_cols,
        (F.col("score") / 100).alias("bleu"),
        F.transform("precisions", lambda p: p / 100).alias("precisions"),
        F.col("bp").alias("brevity_penalty"),
        ratio.alias("length_ratio"),
        F.col("sys_len").alias("translation_length"),
        F.col("ref_len").alias("reference_length"),
    )
