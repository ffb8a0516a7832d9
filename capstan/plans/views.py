"""Views that turn the given tables into caption records, pairs and logits."""

from __future__ import annotations

import re
import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.text import whitespace_tokens
from capstan.operators.pairing import pair_by_key
from capstan.session import scratch_path, spread

PICTURE_SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files."""
    # As a pattern the path may be either; a plain one has to be a folder.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def captions_of(documents: DataFrame) -> DataFrame:
    """Five captions share a picture; the language names the split."""
    image_id = F.expr("doc_id div 5")
    return documents.select(
        image_id.alias("image_id"),
        F.concat(F.lit("img/"), image_id.cast("string"), F.lit(".png")).alias("image_path"),
        F.col("doc_id").alias("caption_id"),
        F.col("text").alias("caption"),
        F.lit(None).cast("string").alias("coco_url"),
        F.concat(image_id.cast("string"), F.lit(".png")).alias("file_name"),
        F.lit(PICTURE_SIDE).alias("height"),
        F.lit(PICTURE_SIDE).alias("width"),
        F.col("lang").alias("split"),
        "lang",
        "source",
    )


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions_of(spread(table(spark, sf_dir, "documents"), "doc_id"))


def pairs_drop_of(documents: DataFrame) -> DataFrame:
    """Reference: the tokens of a text; prediction: about four fifths of them."""
    texts = documents.select(
        F.col("doc_id").alias("id"), "lang", "source", whitespace_tokens("text").alias("reference")
    )
    kept = F.filter("reference", lambda _, i: F.pmod(i * 7 + F.col("id"), F.lit(5)) != 0)
    return texts.withColumn("prediction", kept)


def pairs_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_drop_of(spread(table(spark, sf_dir, "documents"), "doc_id"))


def pairs_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a user turn (prediction) and the assistant turn after it."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("text").alias("prediction")
    )
    told = turns.where(F.col("role") == "assistant").select(
        (F.col("conv_id") * 100 + F.col("turn") - 1).alias("id"), F.col("text").alias("reference")
    )
    # A turn without an answer, or without a question, is no pair.
    return pair_by_key(asked, told, unmatched="drop")


def logits_of(embeddings: DataFrame) -> DataFrame:
    """Eight vectors make a row of logits; every fifth position is ignored."""
    return embeddings.select(
        F.expr("vec_id div 8").alias("id"),
        (F.col("vec_id") % 8).cast("int").alias("pos"),
        F.when(F.col("vec_id") % 5 == 0, -100).otherwise(F.col("label")).alias("label"),
        F.col("embedding").alias("logits"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logits_of(table(spark, sf_dir, "embeddings"))


def label_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight vectors make a picture; its one caption names their labels in order."""
    word = F.struct("vec_id", F.concat(F.lit("l"), F.col("label").cast("string")).alias("word"))
    rows = table(spark, sf_dir, "embeddings").groupBy(F.expr("vec_id div 8").alias("image_id"))
    words = rows.agg(F.sort_array(F.collect_list(word)).alias("words"))
    caption = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    return words.select("image_id", F.col("image_id").alias("caption_id"), caption.alias("caption"))


def vector_features(spark: SparkSession, sf_dir: str, width: int = 64) -> DataFrame:
    """(image_id, features): the mean of a picture's eight vectors."""
    rows = table(spark, sf_dir, "embeddings").groupBy(F.expr("vec_id div 8").alias("image_id"))
    means = [F.avg(F.get("embedding", F.lit(i)).cast("double")).alias(f"m{i}") for i in range(width)]
    return rows.agg(*means).select("image_id", F.array(*[f"m{i}" for i in range(width)]).alias("features"))


def _png(rows: list[bytes], color_type: int) -> bytes:
    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    side = len(rows)
    header = struct.pack(">IIBBBBB", side, side, 8, color_type, 0, 0, 0)
    body = zlib.compress(b"".join(b"\0" + row for row in rows))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def picture_bytes(vec_id: int, embedding) -> bytes:
    """An 8 x 8 picture of a vector: grey, RGB or RGBA by turns."""
    grey = [int(min(255.0, max(0.0, (float(x) + 1.0) * 127.5 // 1))) for x in embedding]
    count = len(grey)
    kind = vec_id % 3
    pixels = []
    for k in range(count):
        rgb = (grey[k], grey[(k + 1) % count], 255 - grey[k])
        pixels.append(bytes([grey[k]]) if kind == 0 else bytes(rgb) + (b"\xc8" if kind == 2 else b""))
    rows = [b"".join(pixels[y : y + PICTURE_SIDE]) for y in range(0, count, PICTURE_SIDE)]
    return _png(rows, (0, 2, 6)[kind])


def with_vectors(captions: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Captions of the pictures that are made: a picture without a vector has no file."""
    return captions.join(embeddings.select(F.col("vec_id").alias("image_id")), "image_id", "left_semi")


def write_pictures(spark: SparkSession, sf_dir: str) -> str:
    """Picture files of all vectors, written by tasks to the shared folder."""
    folder = scratch_path(spark, "pictures")
    local = folder.startswith(("/", "file:"))
    uri = "file://" + re.sub("^file:/+", "/", folder) if local else folder

    def write(frames):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(f"{root}/img", recursive=True)
        for frame in frames:
            for vec_id, embedding in zip(frame["vec_id"], frame["embedding"]):
                with store.open_output_stream(f"{root}/img/{vec_id}.png") as out:
                    out.write(picture_bytes(vec_id, embedding))
            yield pd.DataFrame({"written": [len(frame)]})

    vectors = spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")
    vectors.mapInPandas(write, "written long").agg(F.sum("written")).collect()
    return folder
