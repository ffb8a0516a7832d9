"""Exact global row numbers without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.session import stored

# monotonically_increasing_id() keeps the partition above this bit.
_PARTITION_SHIFT = 33


def global_rank(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Add the 1-based position of every row in a total order.

    Rows are range-partitioned and sorted, so each task numbers its own range;
    a range starts after the summed sizes of those before it. The numbered rows
    are written first because range bounds are sampled: sizes and rows must come
    from one and the same run. The broadcast side has one row per partition.
    """
    slot = f"__slot_{name}"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(ranged.withColumn(slot, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(F.col(slot), _PARTITION_SHIFT)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy(part.alias("__part"))
        .count()
        .select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    position = F.col(slot).bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + position + 1)
        .drop("__part", "__start", slot)
    )
