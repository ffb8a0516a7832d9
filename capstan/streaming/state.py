"""Keyed state of streams: what arrives again counts once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the store that keeps state on disk, which this kind of operator needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SEEN = T.StructType([T.StructField("seen", T.BooleanType())])


def use_state_store(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB."""
    spark.conf.set(STORE_CONF, STORE)


class FirstArrival(StatefulProcessor):
    """Lets the first row of a key through and remembers, in the state store, that it came."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", _SEEN, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = not self.state.exists()
        for number, frame in enumerate(rows):
            # All frames are read; the first row of the first one stands for the key.
            if new and number == 0:
                self.state.update((True,))
                yield frame.iloc[:1]

    def close(self) -> None:
        pass


class RunningSums(StatefulProcessor):
    """Sums of some columns of a key's rows, each id once; every batch that changes them gives them anew."""

    def __init__(self, id_col: str, id_type: T.DataType, sums: list[str]):
        self.id_col, self.id_type, self.sums = id_col, id_type, sums

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ids = handle.getMapState("ids", T.StructType([T.StructField("id", self.id_type)]), _SEEN)
        fields = [T.StructField(c, T.DoubleType()) for c in ("n", *self.sums)]
        self.total = handle.getValueState("total", T.StructType(fields))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total = list(self.total.get()) if self.total.exists() else [0.0] * (1 + len(self.sums))
        before = total[0]
        for frame in rows:
            for id_, values in zip(frame[self.id_col].tolist(), frame[self.sums].to_numpy("float64").tolist(), strict=True):
                if not self.ids.containsKey((id_,)):
                    self.ids.updateValue((id_,), (True,))
                    total = [total[0] + 1, *[a + b for a, b in zip(total[1:], values, strict=True)]]
        if total[0] != before:
            self.total.update(tuple(total))
            yield pd.DataFrame([[*key, *total]])

    def close(self) -> None:
        pass


def once_per_id(stream: DataFrame, id_col: str, ttl_ms: int | None = None) -> DataFrame:
    """The rows of a stream whose id did not arrive before.

    An id is remembered for ``ttl_ms`` milliseconds, or for good, which Spark's
    own operator does without a Python call an id. Ids are spread over tasks by
    their hash; the state of each is one flag.
    """
    use_state_store(stream.sparkSession)
    if ttl_ms is None:
        return stream.dropDuplicates([id_col])
    processor = FirstArrival(ttl_ms)
    return stream.groupBy(id_col).transformWithStateInPandas(processor, stream.schema, "Append", "ProcessingTime")


def running_sums(stream: DataFrame, group_col: str, id_col: str, sums: list[str], salts: int = 16) -> DataFrame:
    """(group_col, salt, n, sums): running sums of a group over all batches, each id counted once.

    A group is kept in ``salts`` parts by the hash of the id, so a hot group is
    many keys and an id is always in the same one. Each batch gives the parts it
    changed; the latest of each add up, see :func:`latest_sums`.
    """
    use_state_store(stream.sparkSession)
    salted = stream.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
    fields = [stream.schema[group_col], T.StructField("salt", T.IntegerType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ("n", *sums)]
    processor = RunningSums(id_col, stream.schema[id_col].dataType, sums)
    rows = salted.select(group_col, "salt", id_col, *sums).groupBy(group_col, "salt")
    return rows.transformWithStateInPandas(processor, T.StructType(fields), "Update", "None")


def latest_sums(batches: DataFrame, group_col: str, sums: list[str]) -> DataFrame:
    """(group_col, n, sums) from the written batches of :func:`running_sums` (with ``batch_id``)."""
    last = F.max(F.struct("batch_id", "n", *sums)).alias("last")
    parts = batches.groupBy(group_col, "salt").agg(last)
    return parts.groupBy(group_col).agg(*[F.sum(f"last.{c}").alias(c) for c in ("n", *sums)])
