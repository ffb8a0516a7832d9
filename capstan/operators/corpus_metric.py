"""A user's own metric of a whole corpus: states of batches, merged in a tree."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Protocol, TypeVar

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from capstan.session import stored

State = TypeVar("State")

# Groups whose states a task holds before it hands them on.
GROUPS_AT_ONCE = 1024
# States that one merge takes, about.
FAN_IN = 32


class CorpusMetric(Protocol[State]):
    """What a user writes; states must be picklable, merging associative up to rounding."""

    def zero(self) -> State: ...

    def accumulate(self, state: State, predictions: list[str], references: list[str]) -> State: ...

    def merge(self, state: State, other: State) -> State: ...

    def finish(self, state: State) -> float: ...


def _partial_states(
    pairs: DataFrame, make_metric: Callable[[], CorpusMetric], group_cols: list[str], schema: T.StructType
) -> DataFrame:
    """One state per task and group: a task adds up the batches it sees."""

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric = make_metric()
        first = TaskContext.get().partitionId() << 32
        number = 0
        held: dict[tuple, object] = {}

        def rows() -> pa.RecordBatch:
            nonlocal number
            values = [dict(zip(group_cols, key, strict=True)) for key in held]
            parts = range(first + number, first + number + len(held))
            number += len(held)
            for value, part, state in zip(values, parts, held.values(), strict=True):
                value |= {"part": part, "state": pickle.dumps(state)}
            held.clear()
            return pa.RecordBatch.from_pylist(values, schema=arrow)

        for batch in batches:
            frame = batch.to_pylist()
            by_group: dict[tuple, tuple[list, list]] = {}
            for row in frame:
                sides = by_group.setdefault(tuple(row[c] for c in group_cols), ([], []))
                sides[0].append(row["prediction"])
                sides[1].append(row["reference"])
            for key, sides in by_group.items():
                state = held[key] if key in held else metric.zero()
                held[key] = metric.accumulate(state, *sides)
                if len(held) >= GROUPS_AT_ONCE:
                    yield rows()
        if held:
            yield rows()

    texts = [F.coalesce(F.col(side), F.lit("")).alias(side) for side in ("prediction", "reference")]
    return pairs.select(*group_cols, *texts).mapInArrow(run, schema)


def _most_states(states: DataFrame, group_cols: list[str]) -> int:
    return states.groupBy(*group_cols).count().agg(F.max("count")).first()[0] or 0


def corpus_metric(
    pairs: DataFrame,
    make_metric: Callable[[], CorpusMetric],
    group_cols: list[str] = (),
    name: str = "value",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(group_cols, name): a user's corpus metric of text pairs (prediction, reference), one row per group.

    ``make_metric`` runs once per task. Tasks accumulate their batches; their
    states meet about ``fan_in`` at a time, in rounds, until a group has one, so
    no task takes all states of a group, however hot it is. Null texts are
    empty, null groups are a group. Without groups there is one row, also for no
    pairs.
    """
    group_cols = list(group_cols)
    fields = [pairs.schema[c] for c in group_cols]
    schema = T.StructType([*fields, T.StructField("part", T.LongType()), T.StructField("state", T.BinaryType())])
    states = stored(_partial_states(pairs, make_metric, group_cols, schema), "states")

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        metric = make_metric()
        frame = frame.sort_values("part")
        state = pickle.loads(frame["state"].iloc[0])
        for other in frame["state"].iloc[1:]:
            state = metric.merge(state, pickle.loads(other))
        first = frame.iloc[:1].copy()
        first["state"] = [pickle.dumps(state)]
        return first[schema.names]

    most = _most_states(states, group_cols)
    while most > 1:
        bucket = F.pmod(F.xxhash64("part"), F.lit(-(-most // fan_in))).alias("__bucket")
        states = states.withColumn("__bucket", bucket).groupBy(*group_cols, "__bucket").applyInPandas(merged, schema)
        states = stored(states, "states")
        most = _most_states(states, group_cols)
    if not group_cols and not most:
        empty = make_metric()
        value = float(empty.finish(empty.zero()))
        return pairs.sparkSession.range(1).select(F.lit(value).alias(name))

    result = T.StructType([*fields, T.StructField(name, T.DoubleType())])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric = make_metric()
        for batch in batches:
            values = [float(metric.finish(pickle.loads(s))) for s in batch.column("state").to_pylist()]
            columns = [batch.column(c) for c in group_cols]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.float64())], names=result.names)

    return states.mapInArrow(finished, result)
