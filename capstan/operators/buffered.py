"""A seeded shuffle with a buffer of fixed size in each split of the input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows that take their places in the buffer at a time.
ROWS_AT_ONCE = 4096


def draws(random: np.random.Generator, buffer_size: int, rows: int) -> np.ndarray:
    """Places of the buffer that the next rows take over, in order."""
    return random.integers(0, buffer_size, rows)


def _exchanged(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What leaves when row k takes ``places[k]``, and what lies in the buffer at the end.

    Both as positions in the buffer followed by the new rows: a row leaves its
    place to the next one that draws it.
    """
    order = np.argsort(places, kind="stable")
    again = np.append(False, places[order[1:]] == places[order[:-1]])[: len(places)]
    leaves = places.copy()
    leaves[order[again]] = size + order[np.nonzero(again)[0] - 1]
    held = np.arange(size)
    held[places] = size + np.arange(len(places))
    return leaves, held


def buffered_shuffle(
    df: DataFrame, buffer_size: int, seed: int, split: str = "split_id", position: str = "position"
) -> DataFrame:
    """Rows with the number of their split and their place in its shuffled order.

    Each split of the input fills a buffer of ``buffer_size`` rows; every further
    row takes the place of a random one, which comes out; at the end those left
    come out in random order. No row moves between tasks and a task holds one
    buffer, whatever the size of its split. The same splits and seed give the
    same order, so a task that is run again repeats its rows.

    A row comes out at most ``buffer_size`` - 1 places early. Ordering by split
    and place gives one order of the whole table.
    """
    if buffer_size < 1:
        raise ValueError("a buffer holds at least one row")
    fields = [T.StructField(split, T.IntegerType()), T.StructField(position, T.LongType())]
    schema = T.StructType([*df.schema.fields, *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        random = np.random.default_rng([seed, number])
        out = 0

        def numbered(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal out
            places = pa.array(range(out, out + rows.num_rows), pa.int64())
            out += rows.num_rows
            full = rows.append_column(split, pa.array([number] * rows.num_rows, pa.int32())).append_column(position, places)
            yield from full.cast(arrow).combine_chunks().to_batches()

        buffer = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = pa.Table.from_batches([batch.slice(start, ROWS_AT_ONCE)])
                missing = buffer_size if buffer is None else buffer_size - buffer.num_rows
                if missing:
                    first = rows.slice(0, missing)
                    buffer = first if buffer is None else pa.concat_tables([buffer, first])
                    rows = rows.slice(missing)
                if rows.num_rows:
                    leaves, held = _exchanged(draws(random, buffer_size, rows.num_rows), buffer_size)
                    both = pa.concat_tables([buffer, rows]).combine_chunks()
                    yield from numbered(both.take(pa.array(leaves)))
                    buffer = both.take(pa.array(held)).combine_chunks()
        if buffer is not None:
            yield from numbered(buffer.take(pa.array(random.permutation(buffer.num_rows))))

    return df.mapInArrow(run, schema)
