"""The buffered shuffle against a plain buffer."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capstan.operators import buffered as BU
from capstan.plans import jobs
from capstan.schemas import CAPTIONS
from capstan.settings import EvaluateSettings, TrainDataSettings


def plain(rows, size, seed, split):
    """One row at a time: with a full buffer a random row makes room and comes out."""
    random = np.random.default_rng([seed, split])
    buffer, out = rows[:size], []
    rest = rows[size:]
    for start in range(0, len(rest)):
        at = int(random.integers(0, size))
        out.append(buffer[at])
        buffer[at] = rest[start]
    return out + [buffer[i] for i in random.permutation(len(buffer))]


@given(st.lists(st.integers(0, 6), max_size=40))
@settings(max_examples=200, deadline=None)
def test_exchange_is_one_row_after_the_other(places):
    size = 7
    buffer, out = list(range(size)), []
    for k, at in enumerate(places):
        out.append(buffer[at])
        buffer[at] = size + k
    leaves, held = BU._exchanged(np.array(places, np.int64), size)
    assert leaves.tolist() == out and held.tolist() == buffer


@pytest.mark.parametrize(("size", "at_once"), [(1, 4096), (7, 4096), (30, 11), (1000, 5), (10_000, 4096)])
def test_plain_buffer(spark, monkeypatch, size, at_once):
    monkeypatch.setattr(BU, "ROWS_AT_ONCE", at_once)
    # One draw at a time gives the numbers that many at a time give.
    monkeypatch.setattr(BU, "draws", lambda random, n, rows: np.array([int(random.integers(0, n)) for _ in range(rows)]))
    df = spark.range(0, 700, numPartitions=3).withColumn("text", F.concat(F.lit("t"), "id"))
    split = {r["id"]: r["s"] for r in df.withColumn("s", F.spark_partition_id()).collect()}
    for seed in (1, 2):
        made = BU.buffered_shuffle(df, size, seed).collect()
        for number in range(3):
            rows = sorted((r["position"], r["id"], r["text"]) for r in made if r["split_id"] == number)
            wanted = plain(sorted(i for i, s in split.items() if s == number), size, seed, number)
            assert rows == [(k, i, f"t{i}") for k, i in enumerate(wanted)]


def test_same_splits_same_order(spark):
    df = spark.range(0, 5000, numPartitions=4)
    first, again, other = (BU.buffered_shuffle(df, 100, seed).collect() for seed in (5, 5, 6))
    assert first == again and first != other
    assert sorted(r["id"] for r in first) == list(range(5000))
    assert "Exchange" not in BU.buffered_shuffle(df, 100, 5)._jdf.queryExecution().executedPlan().toString()


def test_no_rows_and_no_room(spark):
    assert BU.buffered_shuffle(spark.range(0), 5, 1).count() == 0
    with pytest.raises(ValueError):
        BU.buffered_shuffle(spark.range(3), 0, 1)


def test_jobs_take_the_buffer(spark):
    rows = [(k, f"img/{k}.png", k, f"w{k} x", None, None, 8, 8, "train") for k in range(60)]
    captions = spark.createDataFrame(rows, CAPTIONS).repartition(2, "caption_id")
    settings = EvaluateSettings(num_test_data=10, shuffle_order="buffer", shuffle_buffer=8)
    chosen = jobs.select_test(captions, settings)
    placed = sorted((r["split_id"], r["position"], r["caption_id"]) for r in BU.buffered_shuffle(captions, 8, 42).collect())
    assert sorted(r["caption_id"] for r in chosen.collect()) == sorted(i for _, _, i in placed[:10])
    assert chosen.columns == captions.columns
    vocabulary = jobs.V.build_vocabulary(captions.select(F.split("caption", " ").alias("t")), "t")
    train = TrainDataSettings(shuffle_order="buffer", shuffle_buffer=8, max_sequence_length=5)
    data = jobs.prepare_train(captions, captions.limit(3), vocabulary, train)
    assert sorted((r["split_id"], r["position"], r["caption_id"]) for r in data.train.collect()) == placed
    assert EvaluateSettings().shuffle_buffer == 10_000 and TrainDataSettings().shuffle_buffer == 1_000
