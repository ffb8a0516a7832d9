"""Caption records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.schemas import CAPTIONS


def read_captions(
    spark: SparkSession, path: str, split: str | None = None, file_format: str = "parquet"
) -> DataFrame:
    """Lazy scan of one split; tables stored by split are pruned by folder."""
    captions = spark.read.format(file_format).schema(CAPTIONS).load(path)
    return captions if split is None else captions.where(F.col("split") == split)


def stream_captions(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Caption files as they arrive."""
    return (
        spark.readStream.format(file_format)
        .schema(CAPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
