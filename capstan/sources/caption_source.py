"""Caption JSON as a Spark data source: by configuration, folder and split, in byte ranges, batch and stream."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)
from pyspark.sql.pandas.types import to_arrow_schema

from capstan.schemas import CAPTIONS

FORMAT = "captions"
# The configuration that jobs read.
CONFIG = "2014"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
BYTES_PER_PARTITION = 64 << 20
ROWS_AT_ONCE = 4096
READ_AT_ONCE = 1 << 20
# Endings of files of records, a JSON object a line.
ENDINGS = (".json", ".jsonl", ".ndjson")


@dataclass
class FileRange(InputPartition):
    """Lines of a file that start at or after ``start`` and before ``end``."""

    path: str
    split: str
    start: int
    end: int


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it; any task can open it again."""
    plain = re.sub("^file:/+", "/", folder)
    if re.match(r"^[a-z][a-z0-9+.-]*://", plain):
        return fs.FileSystem.from_uri(plain)
    return fs.LocalFileSystem(), plain


def _files(folder: str, splits: list[str] | None) -> list[tuple[str, str, int]]:
    """(split, path, size) of record files; splits that are not asked for are not listed.

    A split is a folder, named ``train`` or, as Spark writes partitions, ``split=train``.
    """
    store, root = file_system(folder)
    found = []
    for entry in store.get_file_info(fs.FileSelector(root)):
        split = entry.base_name.removeprefix("split=")
        if entry.type != fs.FileType.Directory or split.startswith(("_", ".")) or (splits is not None and split not in splits):
            continue
        for file in store.get_file_info(fs.FileSelector(entry.path, recursive=True)):
            hidden = file.base_name.startswith(("_", "."))
            if file.type == fs.FileType.File and file.base_name.endswith(ENDINGS) and not hidden:
                found.append((split, file.path, file.size))
    return sorted(found)


def _whole_lines(store: fs.FileSystem, path: str, size: int) -> int:
    """Bytes up to and with the last line end of a file that may still be written."""
    with store.open_input_file(path) as file:
        end = size
        while end:
            start = max(0, end - READ_AT_ONCE)
            file.seek(start)
            at = file.read(end - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def lines_of(store: fs.FileSystem, part: FileRange) -> Iterator[bytes]:
    """The lines of a range: one that starts before it belongs to the range before."""
    with store.open_input_file(part.path) as file:
        # A byte earlier: a line that starts right at the range follows a line end.
        position = max(0, part.start - 1)
        file.seek(position)
        rest, skip = b"", part.start > 0
        while True:
            block = file.read(READ_AT_ONCE)
            if not block:
                if rest and not skip and position - len(rest) < part.end:
                    yield rest
                return
            data = rest + block
            start = position - len(rest)
            position += len(block)
            *whole, rest = data.split(b"\n")
            for line in whole:
                if start >= part.end:
                    return
                if not skip:
                    yield line
                skip = False
                start += len(line) + 1
            if start >= part.end:
                return


def _records(folder: str, part: FileRange, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the asked columns; other fields of a record are not kept, missing ones are null."""
    arrow = to_arrow_schema(schema)
    store, _ = file_system(folder)
    rows: list[dict] = []
    for line in lines_of(store, part):
        if line.strip():
            record = json.loads(line)
            rows.append({f.name: part.split if f.name == "split" else record.get(f.name) for f in arrow})
        if len(rows) == ROWS_AT_ONCE:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class CaptionReader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType, splits: list[str] | None, size: int):
        self.folder, self.schema, self.splits, self.size = folder, schema, splits, size

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality and membership of the split choose folders; Spark applies all others."""
        for condition in filters:
            values = None
            if isinstance(condition, EqualTo) and condition.attribute == ("split",):
                values = [condition.value]
            elif isinstance(condition, In) and condition.attribute == ("split",):
                values = list(condition.value)
            if values is None:
                yield condition
            else:
                self.splits = [s for s in values if self.splits is None or s in self.splits]

    def partitions(self) -> list[InputPartition]:
        return [
            FileRange(path, split, start, min(size, start + self.size))
            for split, path, size in _files(self.folder, self.splits)
            for start in range(0, size, self.size)
        ]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        # Spark makes one partition of a source that has none.
        if partition is not None:
            yield from _records(self.folder, partition, self.schema)


class CaptionStream(DataSourceStreamReader):
    """Lines as they are appended: an offset is how far each file has been read, by whole lines."""

    def __init__(self, folder: str, schema: T.StructType, splits: list[str] | None, size: int):
        self.folder, self.schema, self.splits, self.size = folder, schema, splits, size

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, _ = file_system(self.folder)
        files = _files(self.folder, self.splits)
        return {f"{split}/{path}": _whole_lines(store, path, size) for split, path, size in files}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for name, until in sorted(end.items()):
            split, path = name.split("/", 1)
            for at in range(start.get(name, 0), until, self.size):
                out.append(FileRange(path, split, at, min(until, at + self.size)))
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from _records(self.folder, partition, self.schema)


class CaptionSource(DataSource):
    """Options: ``path`` (data folder), ``config``, ``split``, ``columns`` (comma-separated), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        """The caption record, or those of its columns that are asked for."""
        asked = self.options.get("columns")
        if not asked:
            return CAPTIONS
        return T.StructType([CAPTIONS[name.strip()] for name in asked.split(",")])

    def _parts(self, schema: T.StructType) -> tuple:
        folder = "/".join([self.options["path"].rstrip("/"), *filter(None, [self.options.get("config")])])
        split = self.options.get("split")
        return folder, schema, [split] if split else None, int(self.options.get("partitionBytes", BYTES_PER_PARTITION))

    def reader(self, schema: T.StructType) -> CaptionReader:
        return CaptionReader(*self._parts(schema))

    def streamReader(self, schema: T.StructType) -> CaptionStream:
        return CaptionStream(*self._parts(schema))


def _configured(reader, spark: SparkSession, path: str, config: str, split: str | None, columns, partition_bytes: int):
    spark.dataSource.register(CaptionSource)
    spark.conf.set(PUSHDOWN_CONF, "true")
    options = {"config": config, "split": split, "columns": columns and ",".join(columns), "partitionBytes": partition_bytes}
    return reader.format(FORMAT).options(**{k: v for k, v in options.items() if v}).load(path)


def load_captions(
    spark: SparkSession,
    path: str,
    config: str = CONFIG,
    split: str | None = None,
    columns: list[str] | None = None,
    partition_bytes: int = BYTES_PER_PARTITION,
) -> DataFrame:
    """Caption records of a configuration below a data folder, all splits or one.

    A filter on ``split`` chooses folders before anything is listed below them;
    files are cut into ranges of bytes, so one large file is many tasks; records
    become Arrow batches of ``columns`` alone. The folder may lie in any file
    system that both the driver and the executors reach.
    """
    return _configured(spark.read, spark, path, config, split, columns, partition_bytes)


def stream_loaded_captions(
    spark: SparkSession,
    path: str,
    config: str = CONFIG,
    split: str | None = None,
    columns: list[str] | None = None,
    partition_bytes: int = BYTES_PER_PARTITION,
) -> DataFrame:
    """The same records as they arrive, also those appended to files read before."""
    return _configured(spark.readStream, spark, path, config, split, columns, partition_bytes)
