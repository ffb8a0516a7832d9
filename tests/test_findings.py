"""Tables in many files, captions without pictures, and work that stays where it is made."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capstan.functions import slices as SL
from capstan.functions import text as X
from capstan.operators import generation as G
from capstan.operators import ngrams as N
from capstan.plans import jobs, queries
from capstan.settings import TrainDataSettings
from capstan.streaming import jobs as ST
from capstan.streaming import state as SS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables as folders of three files: 12 documents, 2 vectors."""
    folder = str(tmp_path_factory.mktemp("tables"))
    documents = spark.range(0, 12, 1, 3).selectExpr(
        "id AS doc_id", "concat('a dog ', id, ' runs') AS text", "'de' AS lang", "'web' AS source"
    )
    documents.write.parquet(f"{folder}/documents.parquet")
    vector = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: ((i * 5 + F.col("id")) % 17 / 8 - 1).cast("float"))
    vectors = spark.range(0, 2, 1, 2).select(F.col("id").alias("vec_id"), vector.alias("embedding"), F.lit(1).alias("label"))
    vectors.write.parquet(f"{folder}/embeddings.parquet")
    return folder


def test_stream_of_a_table_in_many_files(spark, folder, tmp_path):
    stream = queries._stream(spark, folder, "documents").select("doc_id")
    ST.stream_rows(stream, str(tmp_path / "rows"), str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == list(range(12))


def test_arrivals_are_not_one_file(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    stream = queries._arriving_twice(spark, folder, "documents", "doc_id")
    assert len([f for f in os.listdir(tmp_path / "arrivals") if f.endswith(".parquet")]) > 2
    batches = []
    query = ST.stream_batches(stream, lambda b: batches.append(b.count()) or b, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    # A part comes first, then the whole table.
    assert batches[0] == 8 and sum(batches) == 20


def test_once_per_id_is_native(spark, folder):
    plan = SS.once_per_id(queries._stream(spark, folder, "documents"), "doc_id")._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "Python" not in plan


def test_captions_without_a_vector_have_no_picture(spark, folder):
    rows = queries.image_pixels(spark, folder).collect()
    assert sorted(r["caption_id"] for r in rows) == list(range(10)) and {r["n_values"] for r in rows} == {3 * 224 * 224}


def test_pixels_are_packed_for_joins(spark, folder):
    captions = queries._pictured(spark, folder)
    settings = TrainDataSettings()
    whole = {r["image_path"]: r["pixel_values"] for r in jobs.picture_inputs(captions, settings).collect()}
    labels = captions.select("caption_id", F.array(F.lit(1)).alias("labels"))
    rows = jobs.features(captions, labels, jobs.packed_inputs(captions, settings), ("image_path",))
    assert {tuple(r["pixel_values"]) for r in rows.collect()} == {tuple(v) for v in whole.values()} and len(whole) == 2
    plan = queries.train_pixels(spark, folder)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line and "image_path" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_pictures_are_dealt_out(spark, folder):
    captions = queries._pictured(spark, folder)
    from capstan.sources.pictures import read_pictures_at

    # Adaptive execution merges no tasks that open pictures, however short their paths are.
    assert read_pictures_at(captions).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def wanted_grams(rows, order):
    counts = {}
    for key, tokens in rows:
        for n in range(1, order + 1):
            for p in range(len(tokens or []) - n + 1):
                gram = tokens[p : p + n]
                text = None if None in gram else X.GRAM_SEPARATOR.join(gram)
                counts.setdefault((key, n), Counter())[text] += 1
    return counts


def test_gram_counts_of_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(SL.slices, "__kwdefaults__", {"size": 7})
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), [rng.choice(["a", "b", "ä", None]) for _ in range(rng.randrange(9))]) for _ in range(60)]
    rows += [(9, None), (10, [])]
    wanted = wanted_grams(rows, 4)
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(3)
    found = {}
    for r in N.gram_counts(df, "id", "t").collect():
        assert r["gram"] not in found.setdefault((r["id"], r["n"]), {})
        found[r["id"], r["n"]][r["gram"]] = r["count"]
    assert found == wanted
    listed = N.gram_counts(df, "id", "t", listed=True).collect()
    assert {(r["id"], r["n"]): {g["gram"]: g["count"] for g in r["grams"]} for r in listed} == wanted


def test_grams_are_not_sorted(spark, folder):
    plan = queries.ngram_counts(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_pairs_of_a_picture_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (None, ["a", "b"]), (1, ["a", "c"])], "k long, seq array<string>")
    table = G.next_tokens(G.bigrams(df, ["k"], "seq"), ["k"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.index("Generate")
    assert sorted(tuple(r)[:4] for r in table.collect()) == [(1, "a", "b", 1), (1, "a", "c", 2), (1, "b", "a", 1)]


def test_slices_are_bounded():
    texts = pa.array(["x" * (k % 50) for k in range(200)] + [None, "y" * 900])
    parts = [p for (p,) in SL.slices(texts, size=100)]
    assert pa.concat_arrays(parts).equals(texts) and len(parts) > 10
    assert max(sum(len(t or "") for t in p.to_pylist()) for p in parts) <= 1400
    lines = pa.array([[["a", "b"], []], None, [["c"]], []], pa.list_(pa.list_(pa.string())))
    assert SL.rows_of(lines.slice(1)) == [None, [["c"]], []] and SL.rows_of(lines) == lines.to_pylist()
    made = SL.by_slices(lambda a: [len(t or "") for t in a], pa.int32(), texts)
    assert np.array_equal(made.to_numpy(), [len(t or "") for t in texts.to_pylist()])


def test_first_tokens(spark):
    texts = ["", " ", "a", " a  b\tc ", "a b c d e", "\n\na b", "a b ", None, "  a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 2, 3):
        rows = df.select(X.first_tokens("t", n).alias("a"), F.slice(X.whitespace_tokens("t"), 1, n).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in rows)
