"""Fixed-length label arrays as pure Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label of a position the loss must skip.
IGNORED = -100


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def truncate(ids: Column | str, length: int) -> Column:
    return F.slice(_column(ids), 1, length)


def add_special(ids: Column | str, length: int, start: int | None, end: int | None) -> Column:
    """Start and end ids around the ids; they count toward ``length``."""
    room = length - (start is not None) - (end is not None)
    parts = [truncate(ids, room)]
    if start is not None:
        parts.insert(0, F.array(F.lit(start)))
    if end is not None:
        parts.append(F.array(F.lit(end)))
    return F.concat(*parts)


def _fill(ids: Column | str, length: int, value: int) -> Column:
    ids = _column(ids)
    missing = F.greatest(F.lit(0), F.lit(length) - F.size(ids))
    return F.concat(ids, F.array_repeat(F.lit(value), missing))


def pad(ids: Column | str, length: int, pad_id: int) -> Column:
    return _fill(ids, length, pad_id)


def mask(ids: Column | str, pad_id: int) -> Column:
    """Every PAD becomes the ignored label, also one that is a true end token."""
    return F.transform(
        _column(ids), lambda x: F.when(x == pad_id, F.lit(IGNORED)).otherwise(x)
    )


def fill_ignored(ids: Column | str, length: int) -> Column:
    """Branch without a PAD token: append ignored labels up to ``length``."""
    return _fill(ids, length, IGNORED)


def unmask(labels: Column | str, pad_id: int | None, end_id: int | None = None) -> Column:
    replacement = end_id if pad_id is None else pad_id
    return F.transform(
        _column(labels), lambda x: F.when(x == IGNORED, F.lit(replacement)).otherwise(x)
    )


def checked_array(values: Column | str, element: str, length: int, what: str = "values") -> Column:
    """Cast to the declared type; a row of any other length fails the job."""
    values = _column(values).cast(f"array<{element}>")
    message = F.concat(
        F.lit(f"{what} must have {length} entries, found "),
        F.coalesce(F.size(values).cast("string"), F.lit("null")),
    )
    return F.when(F.size(values) == length, values).otherwise(F.raise_error(message))


def checked_labels(labels: Column | str, length: int) -> Column:
    return checked_array(labels, "int", length, "labels")


def make_labels(ids: Column | str, length: int, pad_id: int | None) -> Column:
    """Both branches: pad and mask where a PAD id exists, else fill."""
    ids = truncate(ids, length)
    if pad_id is None:
        return checked_labels(fill_ignored(ids, length), length)
    return checked_labels(mask(pad(ids, length, pad_id), pad_id), length)


def drop_special(ids: Column | str, special: list[int]) -> Column:
    """Remove special tokens and negative fill ids before decoding."""
    return F.filter(_column(ids), lambda x: (x >= 0) & ~x.isin(special))


def token_count(ids: Column | str, pad_id: int | None = None) -> Column:
    """Number of tokens, without PAD where one is given."""
    ids = _column(ids)
    if pad_id is not None:
        ids = F.filter(ids, lambda x: x != pad_id)
    return F.size(ids)
