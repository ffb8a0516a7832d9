"""Picture files to model inputs."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from capstan.functions.pixels import MEAN, SIDE, STD, model_pixels, resized, to_rgb
from capstan.functions.png import read_picture
from capstan.sources.caption_source import file_system

# Pictures per Arrow batch going back to Spark: 16 x 600 kB at side 224.
PICTURES_AT_ONCE = 16
# Fixed value: where a folder keeps the description of a model's input.
EXTRACTOR_FILE = "preprocessor_config.json"
# What makes a picture out of its bytes.
PICTURE_FIELDS = ("height", "width", "channels", "data")
# Columns told of the pixel values of a picture in the task that makes them, so that these go to no Python worker
# again: a type, and a function of the flat values.
Measures = dict[str, tuple[T.DataType, Callable[[np.ndarray], object]]]
PACKED = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary())])


def read_pictures(spark: SparkSession, path: str) -> DataFrame:
    """(image_path, height, width, channels, data) of every readable picture."""
    images = (
        spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    )
    return images.select(
        plain_path(F.col("image.origin")).alias("image_path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def read_pictures_at(paths: DataFrame, path_col: str = "image_path") -> DataFrame:
    """(image_path, height, width, channels, data) of the readable pictures that some rows name.

    Each different path is opened once, by the task that it falls to, through
    the file system all tasks share; no folder is listed. Rows without a path
    name no picture. Pixels lie as in Spark's image source, blue first.
    """
    schema = "image_path string, height int, width int, channels int, data binary"
    kinds = {"height": pa.int32(), "width": pa.int32(), "channels": pa.int32(), "data": pa.binary()}

    def read(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, PICTURES_AT_ONCE):
                found = {"image_path": [], "height": [], "width": [], "channels": [], "data": []}
                for path in batch.column(0).slice(start, PICTURES_AT_ONCE).to_pylist():
                    pixels = _opened(path)
                    if pixels is not None:
                        height, width, channels = pixels.shape
                        blue_first = pixels if channels == 1 else pixels[:, :, [2, 1, 0, 3][:channels]]
                        for name, value in zip(found, (path, height, width, channels, blue_first.tobytes()), strict=True):
                            found[name].append(value)
                if found["data"]:
                    columns = [pa.array(values, kinds.get(name, pa.string())) for name, values in found.items()]
                    yield pa.RecordBatch.from_arrays(columns, names=list(found))

    named = paths.select(F.col(path_col).alias("image_path")).where(F.col("image_path").isNotNull())
    # As many parts as the session asks for: a path is short and its picture is not, so none are merged by size.
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return named.repartition(parts, "image_path").distinct().mapInArrow(read, schema)


def _opened(path: str) -> np.ndarray | None:
    store, place = file_system(path)
    try:
        with store.open_input_stream(place) as file:
            return read_picture(file.read())
    except FileNotFoundError:
        return None


def plain_path(origin: Column) -> Column:
    """``file:/a/b`` and ``file:///a/b`` as ``/a/b``; other schemes stay."""
    return F.regexp_replace(origin, "^file:/+", "/")


def read_extractor(path: str | None) -> dict:
    """``side``, ``mean`` and ``std`` of a model's input from its JSON file, or a folder that holds one.

    The size is one number or a record of equal height and width.
    """
    if path is None:
        return {"side": SIDE, "mean": MEAN, "std": STD}
    file = os.path.join(path, EXTRACTOR_FILE) if os.path.isdir(path) else path
    with open(file, encoding="utf-8") as source:
        found = json.load(source)
    size = found.get("size", SIDE)
    sides = {size[k] for k in ("height", "width") if k in size} if isinstance(size, dict) else {size}
    if len(sides) != 1:
        raise ValueError("the model's input must be square")
    return {"side": int(sides.pop()), "mean": tuple(found.get("image_mean", MEAN)), "std": tuple(found.get("image_std", STD))}


@dataclass
class PackedPictures:
    """Pictures for joins, (image_path, packed), and what makes them a model's input.

    ``packed`` holds (height, width, channels, data), a byte a value: a picture
    as it was read, or at the size of the input where that is less. It has at most a
    quarter of the room of ``pixel_values``, which :func:`with_pixels` makes of
    rows that have been joined.
    """

    rows: DataFrame
    side: int = SIDE
    mean: tuple = MEAN
    std: tuple = STD
    measures: Measures = field(default_factory=dict)


def packed_pictures(pictures: DataFrame, side: int = SIDE, mean=MEAN, std=STD, measures: Measures | None = None) -> PackedPictures:
    """Pictures at the size of the input where they are larger; small ones grow where they are used."""

    def convert(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, PICTURES_AT_ONCE):
                part = batch.slice(start, PICTURES_AT_ONCE)
                fields = {name: part.column(name).to_pylist() for name in PICTURE_FIELDS}
                packed = [_packed(dict(zip(fields, picture, strict=True)), side) for picture in zip(*fields.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("image_path"), pa.array(packed, PACKED)], names=["image_path", "packed"])

    rows = pictures.mapInArrow(convert, "image_path string, packed struct<height: int, width: int, channels: int, data: binary>")
    return PackedPictures(rows, side, mean, std, measures or {})


def _packed(picture: dict, side: int) -> dict:
    if picture["height"] * picture["width"] * picture["channels"] <= 3 * side * side:
        return picture
    rgb = resized(to_rgb(*[picture[name] for name in ("data", "height", "width", "channels")]), side)
    return {"height": side, "width": side, "channels": 3, "data": rgb[:, :, ::-1].tobytes()}


def with_pixels(rows: DataFrame, pictures: PackedPictures) -> DataFrame:
    """Rows with ``pixel_values`` (RGB, resized, normalised, channels first, flat) and measures in place of ``packed``.

    Rows that follow one another with the same picture have it converted once.
    """
    kept = [c for c in rows.columns if c != "packed"]
    side, mean, std, measures = pictures.side, pictures.mean, pictures.std, pictures.measures
    fields = [T.StructField("pixel_values", T.ArrayType(T.FloatType())), *[T.StructField(n, kind) for n, (kind, _) in measures.items()]]
    schema = T.StructType([*[rows.schema[c] for c in kept], *fields])
    kinds = [f.type for f in to_arrow_schema(T.StructType(fields[1:]))]

    def convert(batches):
        last, made, told = None, None, None
        for batch in batches:
            for start in range(0, batch.num_rows, PICTURES_AT_ONCE):
                part = batch.slice(start, PICTURES_AT_ONCE)
                values, measured = [], []
                for picture in part.column("packed").to_pylist():
                    if picture != last:
                        last, made = picture, model_pixels(to_rgb(**picture), side, mean, std)
                        told = [of(made) for _, of in measures.values()]
                    values.append(made)
                    measured.append(told)
                ends = np.cumsum([0] + [len(v) for v in values], dtype=np.int32)
                # One flat buffer: no per-value conversion on the way back.
                pixels = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))
                columns = [pa.array(column, kind) for column, kind in zip(zip(*measured, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pixels, *columns], names=schema.names)

    return rows.select(*kept, "packed").mapInArrow(convert, schema)


def pixel_features(pictures: DataFrame, side: int = SIDE, mean=MEAN, std=STD, measures: Measures | None = None) -> DataFrame:
    """(image_path, pixel_values) and measures: RGB, resized, normalised, channels first, flat."""
    rows = pictures.select("image_path", F.struct(*PICTURE_FIELDS).alias("packed"))
    return with_pixels(rows, PackedPictures(rows, side, mean, std, measures or {}))


def join_pictures(captions: DataFrame, features: DataFrame) -> DataFrame:
    """Captions with the features of their picture.

    Each picture is opened once, before the join; a caption without a readable
    picture fails the job. Several captions may share a picture and one picture
    may have very many: the adaptive skew join splits the caption side. Pixels
    are merge-joined, never broadcast on a guess of their size.
    """
    joined = captions.join(features.withColumn("__read", F.lit(True)).hint("merge"), "image_path", "left")
    message = F.concat(F.lit("no readable picture: "), F.coalesce(F.col("image_path"), F.lit("null")))
    read = F.when(F.col("__read"), True).otherwise(F.raise_error(message).cast("boolean"))
    return joined.where(read).drop("__read")
