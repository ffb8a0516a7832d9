"""Captions and pairs as they arrive; each input is handled once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from capstan.operators.report import finish_metrics, merge_metric_states, metric_state


def stream_rows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Row-wise results of a stream to Parquet: exactly once by the file sink."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_batches(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    output_mode: str = "append",
) -> StreamingQuery:
    """A batch job on every micro-batch.

    Results go to ``path/batch_id=N``; a repeated batch overwrites its own
    folder, so it does not count twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_metric_states(
    tokens: DataFrame, metrics: tuple[str, ...], group_cols: list[str], path: str, checkpoint: str
) -> StreamingQuery:
    """One additive state row per group and micro-batch of token pairs."""
    return stream_batches(
        tokens, lambda batch: metric_state(batch, metrics, group_cols), path, checkpoint
    )


def read_metric_states(states: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Metrics of everything seen so far."""
    return finish_metrics(merge_metric_states(states, group_cols), group_cols)
