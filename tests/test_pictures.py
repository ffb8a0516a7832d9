import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.functions import png as PNG
from capstan.functions.pixels import model_pixels
from capstan.plans import jobs
from capstan.plans.views import _png
from capstan.settings import EvaluateSettings
from capstan.sources import pictures as P


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pictures")
    grey = [bytes([10, 20]), bytes([30, 40])]
    rgb = [bytes([255, 0, 0, 0, 255, 0]), bytes([0, 0, 255, 9, 9, 9])]
    rgba = [bytes([255, 0, 0, 128, 0, 255, 0, 255]), bytes([0, 0, 255, 7, 9, 9, 9, 1])]
    for name, rows, kind in (("grey", grey, 0), ("rgb", rgb, 2), ("rgba", rgba, 6)):
        (folder / f"{name}.png").write_bytes(_png(rows, kind))
    (folder / "broken.png").write_bytes(b"not a picture")
    return str(folder)


def test_layouts(spark, folder):
    rows = {os.path.basename(r["image_path"]): r for r in P.read_pictures(spark, folder).collect()}
    assert set(rows) == {"grey.png", "rgb.png", "rgba.png"}
    assert {name: r["channels"] for name, r in rows.items()} == {"grey.png": 1, "rgb.png": 3, "rgba.png": 4}


def test_features_join_captions(spark, folder):
    features = P.pixel_features(P.read_pictures(spark, folder), side=2)
    captions = spark.createDataFrame(
        [(k, f"{folder}/{name}.png") for k, name in enumerate(["rgb", "rgb", "rgba", "grey", "broken"])],
        "caption_id long, image_path string",
    )
    with pytest.raises(Exception, match="no readable picture: .*broken.png"):
        P.join_pictures(captions, features).collect()
    readable = P.join_pictures(captions.where("caption_id < 4"), features)
    rows = {r["caption_id"]: np.array(r["pixel_values"]) for r in readable.collect()}
    assert set(rows) == {0, 1, 2, 3}
    pixels = np.array([[[255, 0], [0, 9]], [[0, 255], [0, 9]], [[0, 0], [255, 9]]])
    expected = ((pixels / 255 - 0.5) / 0.5).ravel()
    assert np.allclose(rows[0], expected, atol=1e-6)
    assert np.allclose(rows[0], rows[1]) and np.allclose(rows[0], rows[2], atol=1e-6)
    grey = ((np.array([10, 20, 30, 40] * 3) / 255 - 0.5) / 0.5).ravel()
    assert np.allclose(rows[3], grey, atol=1e-6)


def test_paths(spark):
    from pyspark.sql import functions as F

    for origin in ("file:/a/b.png", "file:///a/b.png", "/a/b.png"):
        df = spark.createDataFrame([(origin,)], "o string")
        assert df.select(P.plain_path(F.col("o"))).first()[0] == "/a/b.png"


def filtered_png(pixels, kinds, colour, palette=None):
    """A picture whose line y is written with filter ``kinds[y]``."""
    height, width, step = pixels.shape
    lines, above = [], np.zeros(width * step, np.int64)
    for y, kind in enumerate(kinds):
        line = pixels[y].ravel().astype(np.int64)
        left = np.append(np.zeros(step, np.int64), line[:-step])
        corner = np.append(np.zeros(step, np.int64), above[:-step])
        guess = left + above - corner
        off = np.abs(np.stack([guess - left, guess - above, guess - corner]))
        paeth = np.where((off[0] <= off[1]) & (off[0] <= off[2]), left, np.where(off[1] <= off[2], above, corner))
        base = [np.zeros_like(line), left, above, (left + above) // 2, paeth][kind]
        lines.append(bytes([kind]) + ((line - base) % 256).astype(np.uint8).tobytes())
        above = line

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    body = zlib.compress(b"".join(lines))
    parts = [chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0))]
    parts += [chunk(b"PLTE", palette)] if palette else []
    # The data may lie in several chunks.
    parts += [chunk(b"IDAT", body[:9]), chunk(b"IDAT", body[9:]), chunk(b"IEND", b"")]
    return PNG.SIGNATURE + b"".join(parts)


@pytest.mark.parametrize(("colour", "step"), [(0, 1), (2, 3), (4, 2), (6, 4), (3, 1)])
def test_png_filters_and_layouts(colour, step):
    rng = np.random.default_rng(colour)
    pixels = rng.integers(0, 256 if colour != 3 else 5, (15, 11, step)).astype(np.uint8)
    palette = bytes(range(40, 55)) if colour == 3 else None
    made = PNG.read_picture(filtered_png(pixels, [y % 5 for y in range(15)], colour, palette))
    wanted = {4: pixels[:, :, :1], 3: np.frombuffer(bytes(range(40, 55)), np.uint8).reshape(5, 3)[pixels[:, :, 0]] if colour == 3 else None}
    assert np.array_equal(made, wanted.get(colour, pixels))


def test_what_cannot_be_read():
    whole = filtered_png(np.zeros((3, 3, 3), np.uint8), [0, 1, 2], 2)
    assert PNG.read_picture(whole) is not None
    deep = whole[:24] + b"\x10" + whole[25:]
    for bad in (b"", b"not a picture", PNG.SIGNATURE, whole[:40], deep):
        assert PNG.read_picture(bad) is None


def test_pictures_by_path_are_those_of_the_folder(spark, folder):
    names = ["grey", "rgb", "rgba", "broken", "absent", "rgb"]
    paths = spark.createDataFrame([(f"{folder}/{n}.png",) for n in names] + [(None,)], "image_path string").repartition(3)
    made = P.read_pictures_at(paths)
    rows = sorted(tuple(r) for r in made.collect())
    assert rows == sorted(tuple(r) for r in P.read_pictures(spark, folder).collect()) and len(rows) == 3
    assert "image" not in made._jdf.queryExecution().executedPlan().toString().lower().replace("image_path", "")
    by_address = paths.select(F.concat(F.lit("file://"), "image_path").alias("image_path")).where("image_path LIKE '%grey%'")
    assert [r["channels"] for r in P.read_pictures_at(by_address).collect()] == [1]


def test_extractor_settings(spark, folder, tmp_path):
    (tmp_path / "preprocessor_config.json").write_text('{"size": {"height": 2, "width": 2}, "image_mean": [0, 0, 0], "image_std": [1, 1, 1]}')
    assert P.read_extractor(None)["side"] == P.SIDE
    captions = spark.createDataFrame([(f"{folder}/rgb.png",)], "image_path string")
    settings = EvaluateSettings(feature_extractor_name_or_path=str(tmp_path))
    values = jobs.picture_inputs(captions, settings).first()["pixel_values"]
    assert np.allclose(values, np.array([[255, 0, 0, 9], [0, 255, 0, 9], [0, 0, 255, 9]]).ravel() / 255)
    (tmp_path / "other.json").write_text('{"size": {"height": 2, "width": 3}}')
    with pytest.raises(ValueError):
        P.read_extractor(str(tmp_path / "other.json"))


def test_shrinking_is_an_even_mean():
    """A picture twice as large as the input, against the triangle filter written out."""
    rng = np.random.default_rng(8)
    pixels = rng.integers(0, 256, (8, 8, 3)).astype(np.uint8)
    weights = {-1: 0.125, 0: 0.375, 1: 0.375, 2: 0.125}

    def shrink(line):
        out = []
        for i in range(4):
            near = {2 * i + k: w for k, w in weights.items() if 0 <= 2 * i + k < 8}
            out.append(sum(line[j] * w for j, w in near.items()) / sum(near.values()))
        return np.floor(np.array(out) + 0.5)

    wide = np.stack([[shrink(pixels[y, :, c]) for c in range(3)] for y in range(8)])
    small = np.stack([[shrink(wide[:, c, x]) for x in range(4)] for c in range(3)])
    made = model_pixels(pixels, 4, (0, 0, 0), (1, 1, 1)).reshape(3, 4, 4) * 255
    assert np.abs(made - small.transpose(0, 2, 1)).max() <= 1


def larger_and_small(tmp_path):
    rng = np.random.default_rng(5)
    for name, side, kind, step in (("small", 2, 2, 3), ("large", 9, 2, 3), ("clear", 3, 6, 4), ("even", 3, 0, 1)):
        pixels = rng.integers(0, 256, (side, side, step)).astype(np.uint8)
        (tmp_path / f"{name}.png").write_bytes(_png([row.tobytes() for row in pixels], kind))
    return [f"{tmp_path}/{name}.png" for name in ("small", "large", "clear", "even")]


def test_packed_pictures_are_no_larger_than_they_were(spark, tmp_path):
    paths = larger_and_small(tmp_path)
    pictures = P.read_pictures_at(spark.createDataFrame([(p,) for p in paths], "image_path string"))
    packed = P.packed_pictures(pictures, 3)
    sizes = {os.path.basename(r["image_path"]): len(r["packed"]["data"]) for r in packed.rows.collect()}
    assert sizes == {"small.png": 12, "large.png": 27, "clear.png": 27, "even.png": 9}
    wanted = {r["image_path"]: model_pixels(P.to_rgb(r["data"], r["height"], r["width"], r["channels"]), 3) for r in pictures.collect()}
    # A picture that comes again, beside another or later, has the same values.
    rows = spark.createDataFrame([(k, paths[i]) for k, i in enumerate([0, 0, 1, 0, 2, 3, 1])], "k long, image_path string")
    made = P.with_pixels(P.join_pictures(rows, packed.rows).coalesce(1), packed)
    found = [(r["k"], r["image_path"], r["pixel_values"]) for r in made.collect()]
    assert sorted(k for k, *_ in found) == list(range(7))
    assert all(np.array_equal(np.float32(values), wanted[path]) for _, path, values in found)


def test_measures_are_told_where_values_are_made(spark, tmp_path):
    from capstan.functions.pixels import channel_means
    from capstan.plans.queries import CHANNEL_MEANS

    captions = spark.createDataFrame([(k, k, p) for k, p in enumerate(larger_and_small(tmp_path))], "caption_id long, image_id long, image_path string")
    features = P.pixel_features(P.read_pictures_at(captions), 224, measures=CHANNEL_MEANS)
    labels = captions.select("caption_id", F.array(F.lit(1)).alias("labels"))
    rows = jobs.features(captions, labels, jobs.packed_inputs(captions, EvaluateSettings(), CHANNEL_MEANS))
    assert rows.columns == ["caption_id", "id", "labels", "pixel_values", "means"]
    for made in (features, rows):
        assert made.count() == 4
        for r in made.collect():
            assert np.array_equal(r["means"], channel_means(np.float32(r["pixel_values"])))


def test_pixel_values_go_to_no_python_worker(spark, tmp_path):
    """Rows of 600 kB, 64 MB of them at a time, took an executor's memory; what is moved to a join is small."""
    from capstan.plans import queries

    folder = str(tmp_path)
    spark.range(12).selectExpr("id AS doc_id", "concat('a dog ', id) AS text", "'de' AS lang", "'web' AS source").write.parquet(f"{folder}/documents.parquet")
    vector = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: ((i * 5 + F.col("id")) % 17 / 8 - 1).cast("float"))
    spark.range(2).select(F.col("id").alias("vec_id"), vector.alias("embedding")).write.parquet(f"{folder}/embeddings.parquet")
    for query in (queries.image_pixels, queries.train_pixels):
        made = query(spark, folder)
        assert made.count() == 10
        plan = made._jdf.queryExecution().optimizedPlan().toString().split("\n")
        last = next(line for line in plan if "MapInArrow" in line or "ArrowEvalPython" in line)
        assert "MapInArrow" in last and "pixel_values" in last
    # Captions move to the pictures without their texts.
    joins = [k for k, line in enumerate(plan) if "Join LeftOuter" in line and "image_path" in line]
    assert joins and "labels#" in plan[joins[0] + 1] and "caption#" not in plan[joins[0] + 1]
