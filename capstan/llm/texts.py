"""What several text operators share: Arrow batches in, rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_AT_ONCE = 64


def per_batch(
    df: DataFrame, make: Callable[[], Callable[..., dict[str, Iterable]]], schema: StructType | str
) -> DataFrame:
    """Rows of Python-made columns from the columns of ``df``, batch by batch.

    ``make`` runs once per task and gives the function that turns the columns
    of some rows, as lists, into output columns. Batches are cut to
    ``ROWS_AT_ONCE`` rows, so a task holds few long texts at a time.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                columns = function(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` with null texts empty; rows without an id take no part."""
    id_ = F.col(id_col).cast("long").alias("doc_id")
    return docs.where(F.col(id_col).isNotNull()).select(id_, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
