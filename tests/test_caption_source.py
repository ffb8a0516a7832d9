"""Caption files by ranges of bytes, splits and columns, in batch and as they arrive."""

import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from capstan.functions.labels import IGNORED  # noqa: F401  (the package is importable in tasks)
from capstan.plans import jobs
from capstan.schemas import CAPTIONS
from capstan.settings import EvaluateSettings, PreprocessSettings, TrainDataSettings
from capstan.sources import caption_source as CS


def record(k, split="train"):
    return {"image_id": k // 2, "image_path": f"img/{k // 2}.png", "caption_id": k, "caption": f"text {k} é", "height": 8,
            "width": 8, "more": [1, 2]}


def write(folder, split, name, records, end="\n"):
    path = folder / "2014" / split
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records) + end, encoding="utf-8")


@given(st.lists(st.text("abé", max_size=9), max_size=12), st.integers(1, 40), st.integers(1, 9), st.booleans())
@settings(max_examples=300, deadline=None)
def test_every_line_is_in_one_range(tmp_path_factory, lines, size, block, ended):
    path = str(tmp_path_factory.getbasetemp() / "lines.json")
    data = "\n".join(lines).encode() + (b"\n" if ended else b"")
    with open(path, "wb") as file:
        file.write(data)
    before, CS.READ_AT_ONCE = CS.READ_AT_ONCE, block
    try:
        parts = [CS.FileRange(path, "s", at, min(len(data), at + size)) for at in range(0, len(data), size)]
        found = [line for p in parts for line in CS.lines_of(fs.LocalFileSystem(), p)]
    finally:
        CS.READ_AT_ONCE = before
    wanted = data.split(b"\n")
    assert found == (wanted[:-1] if wanted[-1] == b"" else wanted)


@pytest.fixture
def folder(tmp_path):
    write(tmp_path, "train", "a.json", [record(k) for k in range(40)])
    write(tmp_path, "train", "b.jsonl", [record(k) for k in range(40, 55)], end="")
    write(tmp_path, "validation", "a.json", [record(k) for k in range(100, 107)])
    (tmp_path / "2014" / "train" / "notes.txt").write_text("no records")
    (tmp_path / "2014" / "train" / "_SUCCESS").write_text("")
    (tmp_path / "2015" / "train").mkdir(parents=True)
    return tmp_path


@pytest.mark.parametrize("size", [100, 1000, 1 << 20])
def test_scan(spark, folder, size):
    rows = CS.load_captions(spark, str(folder), partition_bytes=size)
    assert rows.schema == CAPTIONS
    found = sorted((r["split"], r["caption_id"], r["caption"], r["image_id"], r["coco_url"]) for r in rows.collect())
    wanted = [("train", k, f"text {k} é", k // 2, None) for k in range(55)]
    wanted += [("validation", k, f"text {k} é", k // 2, None) for k in range(100, 107)]
    assert found == wanted
    if size == 100:
        assert rows.rdd.getNumPartitions() > 40
    assert CS.load_captions(spark, str(folder), config="2015").count() == 0


def test_splits_and_columns(spark, folder):
    rows = CS.load_captions(spark, str(folder), columns=["caption_id", "split"])
    assert rows.columns == ["caption_id", "split"]
    assert sorted(r[0] for r in rows.where(F.col("split") == "validation").collect()) == list(range(100, 107))
    assert rows.where("split IN ('train', 'other') AND caption_id < 5").count() == 5
    assert CS.load_captions(spark, str(folder), split="validation").count() == 7
    reader = CS.CaptionReader(str(folder / "2014"), CAPTIONS, None, 100)
    left = list(reader.pushFilters([EqualTo(("split",), "validation"), GreaterThan(("caption_id",), 3)]))
    assert left == [GreaterThan(("caption_id",), 3)]
    assert {p.split for p in reader.partitions()} == {"validation"}
    assert list(reader.pushFilters([In(("split",), ("train",))])) == [] and reader.partitions() == []


def test_jobs_read_what_settings_name(spark, folder):
    path = str(folder)
    assert jobs.train_captions(spark, PreprocessSettings(train_data_dir=path)).count() == 55
    assert jobs.valid_captions(spark, TrainDataSettings(valid_data_dir=path)).count() == 7
    assert jobs.held_out_captions(spark, EvaluateSettings(test_data_dir=path, test_data_split="train")).count() == 55


def test_lines_as_they_arrive(spark, folder, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = CS.stream_loaded_captions(spark, str(folder), columns=["caption_id", "split"], partition_bytes=300)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(r["caption_id"] for r in spark.read.parquet(out).collect())

    # The last line of b.jsonl has no end yet, so it may still grow.
    assert run() == [*range(54), *range(100, 107)]
    with open(folder / "2014" / "train" / "b.jsonl", "a") as file:
        file.write("\n" + json.dumps(record(55)) + "\n")
    write(folder, "test", "new.json", [record(200)])
    assert run() == [*range(56), *range(100, 107), 200]
    assert run() == [*range(56), *range(100, 107), 200]


def test_written_by_spark(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "caption_id long, caption string, split string")
    df.write.partitionBy("split").json(f"{tmp_path}/2014")
    got = CS.load_captions(spark, f"file://{tmp_path}", columns=["caption_id", "caption", "split"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a", "x"), (2, None, "y")]
    assert os.listdir(tmp_path) == ["2014"]
