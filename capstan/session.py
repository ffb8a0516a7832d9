"""Session settings, the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Partitions that scans of the test tables are dealt out to; unset (the default on a cluster) they stay as read.
INPUT_PARTITIONS_CONF = "spark.capstan.input.partitions"
ROWS_PER_BUCKET = 250_000


def local_session(cores: int | str = 8, memory: str = "16g", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("capstan")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config(INPUT_PARTITIONS_CONF, str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver found it."""
    context = spark.sparkContext
    if context.getLocalProperty("capstan.shipped"):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="capstan-package-")) / "capstan.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context.setLocalProperty("capstan.shipped", "yes")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset a local session gets a fresh temporary folder. A cluster
    session without it is refused: a machine-local folder would be lost with
    the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="capstan-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, inside the shared folder."""
    return os.path.join(checkpoint_root(spark), "scratch", f"{name}-{uuid.uuid4().hex}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of ``scratch_path`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Tables that results read, by the application that wrote them.
_STORED: dict[str, list[str]] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once and read it from there; see :func:`clear_stored`."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _STORED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> int:
    """Delete the tables that results of this session read; how many they were.

    For the end of a job whose results are written elsewhere: frames made before
    can no longer be read.
    """
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


class Scratch:
    """Tables of one computation in the shared folder; they go at the end of the block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        for path in self._paths:
            remove(self.spark, path)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """A lineage cut that survives lost executors."""
        path = scratch_path(self.spark, name)
        self._paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a small input out, where the session asks for it by a setting."""
    partitions = scan.sparkSession.conf.get(INPUT_PARTITIONS_CONF, None)
    return scan.repartition(int(partitions), key) if partitions else scan


@contextmanager
def bucketed(df: DataFrame, name: str, rows: int, *keys: str) -> Iterator[DataFrame]:
    """A copy of ``df`` in the shared folder, bucketed by ``keys``.

    Joins on the keys then move only their other side, however often they run.
    The copy goes at the end of the block. ``rows``, an upper bound of the row
    count, sets the number of buckets.
    """
    spark = df.sparkSession
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    path = scratch_path(spark, name)
    table = f"{name}_{os.path.basename(path)[-32:]}"
    # Rows already sit with their bucket, so each bucket becomes one file.
    placed = df.repartition(buckets, *keys)
    placed.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, path)
