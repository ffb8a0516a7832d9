"""Seeded order, first n rows, batches, schedules and best runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from capstan.operators.ranking import global_rank


def shuffle_key(seed: int, key: Column | str) -> Column:
    """Pseudo-random sort key: depends on seed and row key, not on partitions."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def shuffled(df: DataFrame, seed: int, key: str) -> DataFrame:
    """The whole table in seeded order."""
    return (
        df.withColumn("__shuffle", shuffle_key(seed, key)).orderBy("__shuffle", key).drop("__shuffle")
    )


def _compared(order: tuple[str, ...], bound: Row) -> tuple[Column, Column]:
    """Whether a row sorts before the bound, and whether it ties with it; nulls sort first."""
    before, tied = F.lit(False), F.lit(True)
    for name in order:
        column, value = F.col(f"`{name}`"), F.lit(bound[name])
        less = F.lit(False) if bound[name] is None else column.isNull() | (column < value)
        before = before | (tied & F.coalesce(less, F.lit(False)))
        tied = tied & column.eqNullSafe(value)
    return before, tied


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in ascending order of some columns, all rows when ``n`` is 0 or more than there are.

    The keys alone are ranked; the key of rank n then cuts the rows by a filter,
    which a scan can use, whatever n is. Of rows that tie with it as many stay
    as make n. Nulls come first, and the result is in order.
    """
    if n <= 0:
        return df
    ranked = global_rank(df.select(*order), *order, name="__head")
    bound = ranked.where(F.col("__head") == n).first()
    if bound is None:
        return df.orderBy(*order)
    before, tied = _compared(order, bound)
    ties = ranked.where((F.col("__head") <= n) & _compared(order, bound)[1]).count()
    return df.where(before).unionByName(df.where(tied).limit(ties)).orderBy(*order)


def shuffled_head(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    keyed = df.withColumn("__shuffle", shuffle_key(seed, key))
    return head(keyed, n, "__shuffle", key).drop("__shuffle")


def batches(df: DataFrame, size: int, *order: Column | str, name: str = "batch") -> DataFrame:
    """Number fixed-size batches in order; the last one may be smaller."""
    ranked = global_rank(df, *order, name="__row")
    return ranked.withColumn(name, F.floor((F.col("__row") - 1) / size)).drop("__row")


def max_steps(rows: DataFrame, epochs: int, batch_size: int) -> DataFrame:
    """One row: training steps that cover ``epochs`` passes over the rows."""
    steps = F.floor(F.count(F.lit(1)) * epochs / batch_size)
    return rows.agg(steps.alias("max_steps"))


def evaluation_steps(log: DataFrame, steps: DataFrame, every: int) -> DataFrame:
    """Log rows on which the run evaluates: every ``every`` steps up to the last."""
    due = log.where((F.col("step") > 0) & (F.col("step") % every == 0))
    return due.withColumn("max_steps", steps.scalar()).where(F.col("step") <= F.col("max_steps"))


def best_step(log: DataFrame, metric: str = "eval_loss", group_cols: list[str] = ()) -> DataFrame:
    """The one kept step: lowest metric, earliest step on a tie."""
    first = F.min(F.struct(F.col(metric), F.col("step"))).alias("best")
    best = log.groupBy(*group_cols).agg(first)
    return best.select(*group_cols, F.col("best.step").alias("step"), F.col(f"best.{metric}").alias(metric))
