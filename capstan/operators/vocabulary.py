"""Corpus vocabulary, token to id and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from capstan.operators.ranking import global_rank
from capstan.session import stored

# Special tokens and their ids; corpus tokens follow.
SPECIAL = {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3}
PAD, UNK, CLS, SEP = 0, 1, 2, 3
FIRST_ID = 4
# Values that share a dictionary; a row of more has one of its own.
PART_VALUES = 1 << 18


def build_vocabulary(df: DataFrame, tokens: Column | str, max_size: int | None = None) -> DataFrame:
    """Tokens ranked by count, then text: (token, token_id, n).

    ``max_size`` keeps only the most frequent tokens, as a fixed model
    vocabulary does; the default keeps all.
    """
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = global_rank(counts, F.desc("n"), F.asc("token"), name="__rank")
    vocabulary = ranked.select(
        "token", (F.col("__rank") + (FIRST_ID - 1)).cast("int").alias("token_id"), "n"
    )
    if max_size is not None:
        vocabulary = vocabulary.where(F.col("token_id") < FIRST_ID + max_size)
    return vocabulary


def special_tokens(vocabulary: DataFrame) -> DataFrame:
    """The special entries in front of a vocabulary."""
    rows = [(token, token_id, 0) for token, token_id in SPECIAL.items()]
    special = vocabulary.sparkSession.createDataFrame(rows, "token string, token_id int, n long")
    return special.unionByName(vocabulary)


def _coded(df: DataFrame, key: str, values: str) -> DataFrame:
    """Rows in parts with a dictionary each: (part, words, keys, sizes, codes).

    A part holds some rows of one task: the different values in ``words``, and
    for all rows together where their values stand in it (``codes``, -1 for a
    null). Values are cut into rows by ``sizes``.
    """
    key_field, value_type = df.schema[key], df.schema[values].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("words", T.ArrayType(value_type)),
            T.StructField("keys", T.ArrayType(key_field.dataType)),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy()
            until = np.cumsum(sizes.astype(np.int64))
            cuts = np.nonzero(np.diff(until // PART_VALUES))[0] + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                rows = batch.slice(start, stop - start)
                listed = rows.column(1).flatten().dictionary_encode()
                codes = pc.fill_null(listed.indices, -1).cast(pa.int32())
                part += 1
                made = [pa.array([part]), listed.dictionary, rows.column(0), pa.array(sizes[start:stop], pa.int32()), codes]
                lists = [pa.ListArray.from_arrays([0, len(c)], c).cast(f.type) for c, f in zip(made[1:], list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([made[0], *lists], schema=arrow)

    return df.select(key, values).mapInArrow(run, schema)


def _looked_up(
    df: DataFrame, key: str, values: str, vocabulary: DataFrame, entry: tuple[str, str], missing, finish, result: T.DataType, name: str
) -> DataFrame:
    """(key, name): each row's values through the vocabulary, then through ``finish``.

    ``entry`` names the columns a value is looked up by and what it becomes,
    ``missing`` stands for values without an entry. Values stay in the part they
    were read in; only a part's different ones, one row each, meet the
    vocabulary, so a value that stands everywhere comes once a part. What comes
    back to a part is as long as its dictionary.
    """
    key_field = df.schema[key]
    coded = stored(_coded(df, key, values), "coded")
    word, becomes = entry
    items = coded.select("part", F.posexplode("words").alias("at", word))
    found = items.join(vocabulary.select(word, becomes), word, "left")
    found = found.select(F.col("part").alias("of"), "at", F.coalesce(becomes, F.lit(missing)).alias("to"))
    schema = T.StructType([T.StructField(key, key_field.dataType), T.StructField(name, result)])
    arrow = to_arrow_schema(schema)

    def run(rows: pa.Table, entries: pa.Table) -> pa.Table:
        columns = rows.select(["keys", "sizes", "codes"]).combine_chunks().to_batches()[0]
        keys, sizes, codes = (columns.column(c)[0].values for c in range(3))
        to = entries.column("to").combine_chunks()
        # Entries come in any order. The one after the last is that of a null.
        to = pa.concat_arrays([to, pa.array([missing], to.type)])
        stands = np.empty(len(to), np.int64)
        stands[entries.column("at").to_numpy()] = np.arange(len(to) - 1)
        stands[-1] = len(to) - 1
        taken = to.take(pa.array(stands[codes.to_numpy(zero_copy_only=False)]))
        ends = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int32)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), taken)
        made = lists if finish is None else finish(lists)
        return pa.Table.from_arrays([keys.cast(arrow.field(key).type), made.cast(arrow.field(name).type)], schema=arrow)

    columns = coded.select("part", "keys", "sizes", "codes")
    return columns.groupBy("part").cogroup(found.groupBy("of")).applyInArrow(run, schema)


def encode(df: DataFrame, key: str, tokens: str, vocabulary: DataFrame, name: str = "ids") -> DataFrame:
    """(key, ids): token arrays to id arrays; unknown tokens become UNK, no tokens none."""
    ids = T.ArrayType(T.IntegerType())
    return _looked_up(df, key, tokens, vocabulary, ("token", "token_id"), UNK, None, ids, name)


def decode(df: DataFrame, key: str, ids: str, vocabulary: DataFrame, name: str = "text") -> DataFrame:
    """(key, text): id arrays to text, without special tokens and fill ids."""
    kept = F.filter(F.col(ids), lambda x: (x >= 0) & (~x.isin(PAD, CLS, SEP)))
    rows = df.select(key, kept.cast("array<int>").alias(ids))
    return _looked_up(
        rows, key, ids, vocabulary, ("token_id", "token"), "[UNK]", lambda x: pc.binary_join(x, " "), T.StringType(), name
    )
