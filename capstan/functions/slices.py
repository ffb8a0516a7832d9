"""Arrow columns some rows at a time, so that a worker's memory does not grow with its batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Tokens, or bytes of text, that become Python objects at a time.
VALUES_AT_ONCE = 1 << 18


def _until(column: pa.Array) -> np.ndarray:
    """Tokens or bytes before each row of a column, and of all rows."""
    if pa.types.is_list(column.type):
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        return _until(column.flatten())[np.append(0, np.cumsum(sizes, dtype=np.int64))]
    if pa.types.is_string(column.type):
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        return np.append(0, np.cumsum(sizes, dtype=np.int64)) // 4
    return np.arange(len(column) + 1)


def slices(*columns: pa.Array, size: int = VALUES_AT_ONCE) -> Iterator[list[pa.Array]]:
    """The same rows of all columns, of about ``size`` tokens; a longer row is alone."""
    rows = len(columns[0])
    until = sum((_until(c) for c in columns), np.arange(rows + 1))
    cuts = np.nonzero(np.diff(until[:-1] // size))[0] + 1
    for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), rows], strict=True):
        yield [c.slice(start, stop - start) for c in columns]


def rows_of(column: pa.Array) -> list:
    """A column of tokens, token rows or token lines as Python lists."""
    if not pa.types.is_list(column.type):
        return column.to_numpy(zero_copy_only=False).tolist()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    flat = rows_of(column.flatten())
    rows = [flat[start:end] for start, end in zip([0, *ends], ends, strict=False)]
    if column.null_count:
        return [row if valid else None for row, valid in zip(rows, column.is_valid().to_pylist(), strict=True)]
    return rows


def by_slices(work: Callable[..., list], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """What ``work`` makes of the rows of some columns, as one column."""
    made = [pa.array(work(*map(rows_of, part)), kind) for part in slices(*columns)]
    return pa.concat_arrays(made)
