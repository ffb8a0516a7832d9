"""Intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from capstan.session import scratch_path, ship_package

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_end_with_the_job(spark: SparkSession) -> Iterator[None]:
    """A written table needs no shuffle file of the job that wrote it."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


class Workspace:
    """Tables an operator writes on its way, in the folder that ``spark.checkpoint.dir`` names.

    A table cuts the lineage and outlives lost executors. ``drop`` removes one
    as soon as nothing reads it any more; those that a returned DataFrame reads
    stay.
    """

    def __init__(self, spark: SparkSession):
        ship_package(spark)
        self.spark = spark
        self._paths: dict[str, str] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        with _shuffle_files_end_with_the_job(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        if name in self._paths:
            self.drop(name)
        self._paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
