"""N-grams and their clipped overlap in (prediction, reference) pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from capstan.functions.slices import slices
from capstan.functions.text import GRAM_SEPARATOR

MAX_ORDER = 4
# Pairs whose tokens a task holds at a time.
PAIRS_AT_ONCE = 512


def counted_grams(rows: pa.Array, group: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, pa.ListArray]]:
    """(groups that have any, their grams and counts) for n = 1..order.

    ``rows`` are token arrays, ``group`` ascending says which one each belongs
    to. Tokens become numbers; a gram of order n is the number of the pair (gram
    of order n-1, next token) and becomes text where it was first seen. A gram
    with a null token is null.
    """
    lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = rows.flatten()
    token = pc.fill_null(tokens.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    words = int(token.max(initial=0)) + 1
    owner = np.repeat(group, lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(token))
    gram = token
    for n in range(1, order + 1):
        at = np.nonzero(left >= n)[0]
        if n > 1:
            joined = np.zeros(len(token), np.int64)
            whole = (gram[at] > 0) & (token[at + n - 1] > 0)
            joined[at] = np.unique(np.where(whole, gram[at] * words + token[at + n - 1], -1), return_inverse=True)[1] + 1
            joined[at[~whole]] = 0
            gram = joined
        size = int(gram.max(initial=0)) + 1
        found, first, times = np.unique(owner[at] * size + gram[at], return_index=True, return_counts=True)
        places = [tokens.take(pa.array(at[first] + k)) for k in range(n)]
        text = pc.binary_join_element_wise(*places, GRAM_SEPARATOR) if n > 1 else places[0]
        having, starts = np.unique(found // size, return_index=True)
        entries = pa.StructArray.from_arrays([text.cast(pa.string()), pa.array(times.astype(np.int64))], ["gram", "count"])
        yield having, pa.ListArray.from_arrays(pa.array(np.append(starts, len(found)).astype(np.int32)), entries)


def gram_counts(df: DataFrame, key: str, tokens: str, max_order: int = MAX_ORDER, listed: bool = False) -> DataFrame:
    """(key, n, gram, count): how often the rows of each key have each gram; ``listed``: (key, n, grams).

    Rows move by key as they are, and come sorted: a task counts the grams of
    some keys at a time, so the grams, many times the rows, are neither shuffled
    nor sorted. A listed row holds all (gram, count) of a key and order.
    """
    rows = df.select(key, tokens).repartition(key).sortWithinPartitions(key)
    grams = T.ArrayType(T.StructType([T.StructField("gram", T.StringType()), T.StructField("count", T.LongType())]))
    schema = T.StructType([df.schema[key], T.StructField("n", T.IntegerType()), T.StructField("grams", grams)])
    arrow = to_arrow_schema(schema)

    def made(keys: pa.Array, texts: pa.Array, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.zeros(len(keys), np.int64)
        group[starts[1:]] = 1
        for n, (having, lists) in enumerate(counted_grams(texts, np.cumsum(group), max_order), 1):
            columns = [keys.take(pa.array(starts[having])), pa.array([n] * len(having), pa.int32()), lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        for batch in batches:
            for part in slices(batch.column(0), batch.column(1)):
                keys, texts = [pa.concat_arrays(both) for both in zip(held, part, strict=True)] if held else part
                codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                starts = np.append(0, np.nonzero(np.diff(codes))[0] + 1)
                # The last key may go on.
                last = int(starts[-1])
                if last:
                    yield from made(keys.slice(0, last), texts.slice(0, last), starts[:-1])
                held = [keys.slice(last), texts.slice(last)]
        if held:
            yield from made(*held, np.zeros(1, np.int64))

    found = rows.mapInArrow(count, schema)
    return found if listed else found.select(key, "n", F.inline("grams"))


def clipped_counts(prediction: pa.ListArray, reference: pa.ListArray, max_order: int) -> dict[str, np.ndarray]:
    """matches_n, predicted_n, expected_n of each pair of a batch, for n = 1..max_order.

    Tokens become numbers; a gram of order n is the number of the pair (gram of
    order n-1, next token). Null arrays count as empty.
    """
    sizes = [pc.fill_null(pc.list_value_length(side), 0).to_numpy().astype(np.int64) for side in (prediction, reference)]
    tokens = pa.concat_arrays([prediction.flatten(), reference.flatten()])
    token = pc.fill_null(tokens.dictionary_encode(null_encoding="encode").indices, -1).to_numpy().astype(np.int64) + 1
    words = int(token.max(initial=0)) + 1
    lengths = np.concatenate(sizes)
    pairs = len(sizes[0])
    side = np.repeat(np.arange(2 * pairs), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(token))
    gram, grams = token, words
    out = {}
    for n in range(1, max_order + 1):
        if n > 1:
            at = np.nonzero(left >= n)[0]
            joined = np.zeros(len(token), np.int64)
            listed, joined[at] = np.unique(gram[at] * words + token[at + n - 1], return_inverse=True)
            gram, grams = joined, max(1, len(listed))
        at = left >= n
        key = side[at] * grams + gram[at]
        mine = side[at] < pairs
        seen, times = np.unique(key[mine], return_counts=True)
        wanted, due = np.unique(key[~mine] - pairs * grams, return_counts=True)
        both, a, b = np.intersect1d(seen, wanted, assume_unique=True, return_indices=True)
        least = np.minimum(times[a], due[b])
        out[f"matches_{n}"] = np.bincount(both // grams, least, pairs).astype(np.int64)
        for what, size in zip(("predicted", "expected"), sizes, strict=True):
            out[f"{what}_{n}"] = np.maximum(size - (n - 1), 0)
    return out


def overlap_wide(pairs: DataFrame, group_cols: list[str] = (), max_order: int = MAX_ORDER) -> DataFrame:
    """One row per pair: id, groups, matches_n, predicted_n, expected_n for n = 1..max_order.

    ``pairs`` has ``id`` and the token arrays ``prediction`` and ``reference``.
    Both sides of a pair are one row, so its grams are counted where it is: no
    shuffle, some pairs at a time.
    """
    keys = ["id", *group_cols]
    rows = pairs.select(*keys, "prediction", "reference")
    names = [f"{what}_{n}" for n in range(1, max_order + 1) for what in ("matches", "predicted", "expected")]
    schema = T.StructType([*[rows.schema[k] for k in keys], *[T.StructField(n, T.LongType()) for n in names]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAIRS_AT_ONCE):
                part = batch.slice(start, PAIRS_AT_ONCE)
                counts = clipped_counts(part.column("prediction"), part.column("reference"), max_order)
                columns = [part.column(k) for k in keys] + [pa.array(counts[n]) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=keys + names)

    return rows.mapInArrow(count, schema)


def overlap(pairs: DataFrame, group_cols: list[str] = (), max_order: int = MAX_ORDER) -> DataFrame:
    """(id, groups, n, matches, predicted, expected) per pair and gram order that occurs.

    Order 0 is one for every pair: it keeps pairs without tokens, and its summed
    ``matches`` are the number of pairs.
    """
    one = F.lit(1).cast("long")
    entries = [F.struct(F.lit(0).alias("n"), *[one.alias(c) for c in ("matches", "predicted", "expected")])]
    for n in range(1, max_order + 1):
        columns = [F.col(f"{c}_{n}").alias(c) for c in ("matches", "predicted", "expected")]
        entries.append(F.struct(F.lit(n).alias("n"), *columns))
    long = overlap_wide(pairs, group_cols, max_order).select("id", *group_cols, F.inline(F.array(*entries)))
    return long.where("predicted + expected > 0")
