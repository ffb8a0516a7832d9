import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.functions.losses import token_loss
from capstan.operators import loss as LO
from capstan.operators import sampling as S
from capstan.operators import scoring as SC
from capstan.operators import vocabulary as V
from capstan.operators.pairing import pair_by_key
from capstan.plans import jobs
from capstan.schemas import CAPTIONS, LENGTHS, PREDICTIONS
from capstan.session import checkpoint_root
from capstan.settings import EvaluateSettings, PredictSettings, PreprocessSettings, Settings, TrainDataSettings
from capstan.sources import sinks
from capstan.sources.captions import read_captions

TEXTS = ["A dog runs fast", "a dog runs", "The cat sleeps", "the cat sleeps on the mat", "a \"quoted\", text", "birds"]


@pytest.fixture(scope="module")
def captions(spark):
    rows = [
        (k // 2, f"img/{k // 2}.png", k, text, None, f"{k // 2}.png", 8, 8, "train" if k < 4 else "validation")
        for k, text in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, CAPTIONS)


def test_scan_by_split(spark, captions, tmp_path):
    path = str(tmp_path / "captions")
    captions.write.partitionBy("split").parquet(path)
    rows = read_captions(spark, path, "validation")
    assert sorted(r["caption_id"] for r in rows.collect()) == [4, 5]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    captions.write.json(str(tmp_path / "json"))
    assert read_captions(spark, str(tmp_path / "json"), file_format="json").count() == 6


def test_preprocess(spark, captions, tmp_path):
    settings = PreprocessSettings(num_train_data=4, output_dir=str(tmp_path))
    written = jobs.run_preprocess(captions, settings)
    assert written.rows == 4
    rows = sinks.read_csv(spark, written.path, LENGTHS).collect()
    assert {r["caption_id"]: r["length"] for r in rows} == {0: 4, 1: 3, 2: 3, 3: 6}
    profile = jobs.length_profile(jobs.preprocess(captions, PreprocessSettings(num_train_data=0)), 3).first()
    assert (profile["n"], profile["min_length"], profile["max_length"]) == (6, 1, 6)
    assert profile["share_over"] == pytest.approx(2 / 6)


def test_features_and_train_data(spark, captions):
    tokens = captions.select("caption_id", F.split(F.lower("caption"), " ").alias("t"))
    vocabulary = V.build_vocabulary(tokens, "t")
    settings = TrainDataSettings(max_sequence_length=5, num_train_data=70, num_valid_data=1)
    data = jobs.prepare_train(
        captions.where("split = 'train'"), captions.where("split = 'validation'"), vocabulary, settings
    )
    train = data.train.collect()
    assert data.train.columns == ["caption_id", "id", "labels"]
    order = [r["caption_id"] for r in S.shuffled(captions.where("caption_id < 4"), 42, "caption_id").collect()]
    assert [r["caption_id"] for r in train] == order
    assert all(len(r["labels"]) == 5 and r["labels"][0] == V.CLS for r in train)
    assert [r["caption_id"] for r in data.valid.collect()] == [4]
    assert data.max_steps.first()["max_steps"] == 2


def test_predict_and_evaluate(spark, captions, tmp_path):
    tokens = captions.select("caption_id", F.split(F.lower("caption"), " ").alias("t"))
    vocabulary = V.build_vocabulary(tokens, "t")
    settings = PredictSettings(output_dir=str(tmp_path), num_test_data=0)
    predictions = jobs.predict(captions, vocabulary, settings)
    path = f"{tmp_path}/prediction.csv"
    sinks.write_csv(predictions.select(*PREDICTIONS.fieldNames()), path)
    rows = {r["id"]: r for r in sinks.read_csv(spark, path, PREDICTIONS).collect()}
    assert len(rows) == len(TEXTS)
    assert rows[4]["labels"] == 'a "quoted", text'
    # Picture 0: "a dog runs" ends, or goes on to "fast".
    assert rows[0]["predicted_labels"] == rows[1]["predicted_labels"]
    assert rows[1]["loss"] == pytest.approx(math.log(2), abs=1e-5)
    some = jobs.predict(captions, vocabulary, PredictSettings(num_test_data=2, shuffle=False))
    assert sorted(r["id"] for r in some.collect()) == [0, 1]
    record = jobs.run_evaluate(predictions, settings, step=7).first()
    again = jobs.run_evaluate(predictions, settings, step=8).first()
    runs = sinks.read_runs(spark, f"{tmp_path}/runs")
    assert runs.count() == 2 and record["n_pairs"] == again["n_pairs"] == 6
    assert S.best_step(runs, "score").first()["step"] == 7
    row = runs.where("step = 7").first()
    assert row["settings"]["num_beams"] == 5 and row["settings"]["predictor_path"] is None
    assert row["eval_samples_per_second"] > 0


def test_settings_column(spark):
    row = spark.range(1).select(F.to_json(_column(EvaluateSettings(num_test_data=3)))).first()[0]
    values = json.loads(row)
    assert values["num_test_data"] == 3 and values["random_seed"] == 42 and values["max_new_tokens"] == 16


def _column(settings: Settings):
    from capstan.settings import settings_column

    return settings_column(settings)


def test_losses(spark):
    rows = [
        (0, 0, 1, [0.0, 0.0]),
        (0, 1, -100, [5.0, 1.0]),
        (1, 0, 0, [1000.0, 0.0]),
        (2, 0, -100, [1.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "id long, pos int, label int, logits array<float>")
    out = {r["id"]: (r["loss"], r["tokens"]) for r in LO.row_losses(df).collect()}
    assert out[0] == (pytest.approx(math.log(2)), 1)
    assert out[1] == (pytest.approx(0.0), 1)
    assert out[2] == (0.0, 0)
    # Batches of two rows: (ln 2 + 0) / 2 tokens, then a batch without tokens.
    loss = LO.evaluation_loss(df, 2).first()
    assert loss["eval_loss"] == pytest.approx(math.log(2) / 2)
    assert LO.token_mean_loss(df).first()["token_loss"] == pytest.approx(math.log(2) / 2)
    assert df.select(token_loss(F.col("logits"), F.col("label"))).count() == 4


def test_model_scoring(spark, tmp_path):
    path = str(tmp_path / "model.npz")
    np.savez(path, weight=np.eye(3, 2), bias=np.array([0.0, 1.0]))
    rows = [(i, [float(i), 1.0, 9.0], -100 if i == 2 else i % 2) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, features array<float>, label int")
    out = {r["id"]: r for r in SC.score_rows(df, SC.linear_predictor(path), 3, batch_size=2).collect()}
    for i, features, label in rows:
        logits = np.array([features[0], features[1] + 1.0])
        expected = 0.0 if label == -100 else np.log(np.exp(logits).sum()) - logits[label]
        assert out[i]["predicted"] == logits.argmax()
        assert out[i]["loss"] == pytest.approx(expected, abs=1e-6)


def test_user_function(spark, captions):
    plan = SC.map_batches(captions, lambda b: {"n": [len(t) for t in b["caption"]]}, "n int", ["caption"])
    assert sorted(r["n"] for r in plan.collect()) == sorted(len(t) for t in TEXTS)


def test_batches_of_a_user_function(spark):
    """Every batch is full but the last of its partition."""
    sizes = SC.map_batches(spark.range(100).repartition(3), lambda b: {"n": [len(b["id"])]}, "n int", batch_size=16)
    found = [r["n"] for r in sizes.collect()]
    assert sum(found) == 100 and sum(n < 16 for n in found) <= 3 and max(found) == 16


def test_model_runs_once_per_row(spark):
    df = spark.range(4).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("features"), F.lit(1).alias("label"))
    plan = SC.score_rows(df, lambda: lambda features: features, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1
    line = next(x for x in plan.splitlines() if "ArrowEvalPython [" in x)
    assert line.count("predict(") <= 1


def test_features_with_pictures(spark, captions):
    labels = captions.select("caption_id", F.array_repeat(F.lit(1), 4).alias("labels"))
    size = 3 * 224 * 224
    pixels = spark.createDataFrame([("img/0.png",), ("img/1.png",), ("img/2.png",)], "image_path string").select(
        "image_path", F.array_repeat(F.lit(0.5).cast("float"), size).alias("pixel_values")
    )
    rows = jobs.features(captions, labels, pixels)
    assert rows.columns == ["caption_id", "id", "labels", "pixel_values"]
    sizes = rows.select("id", "caption_id", F.size("pixel_values").alias("n")).collect()
    assert sorted((r["id"], r["caption_id"], r["n"]) for r in sizes) == [
        (0, 0, size), (0, 1, size), (1, 2, size), (1, 3, size), (2, 4, size), (2, 5, size)
    ]
    with pytest.raises(Exception, match="no readable picture: img/1.png"):
        jobs.features(captions, labels, pixels.where("image_path <> 'img/1.png'")).collect()
    short = pixels.withColumn("pixel_values", F.slice("pixel_values", 1, 5))
    with pytest.raises(Exception, match="pixel_values must have 150528 entries, found 5"):
        jobs.features(captions, labels, short).collect()


def test_pairing_by_key(spark):
    predictions = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "id long, prediction string")
    references = spark.createDataFrame([(1, "x"), (2, "y")], "id long, reference string")
    rows = pair_by_key(predictions, references, unmatched="drop").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a", "x"), (2, "b", "y")]
    assert pair_by_key(predictions.where("id < 3"), references).count() == 2
    with pytest.raises(Exception, match="no reference for key: 3"):
        pair_by_key(predictions, references).collect()
    with pytest.raises(Exception, match="no prediction for key: 2"):
        pair_by_key(predictions.where("id = 1"), references).collect()
    with pytest.raises(Exception, match="duplicate key: 1"):
        pair_by_key(predictions, references.union(references.where("id = 1")), unmatched="drop").collect()
    plan = pair_by_key(predictions, references)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") <= 2


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_hot_picture(spark):
    # One picture holds two thirds of the captions.
    rows = [
        (0 if k % 3 else k, f"img/{k}.png", k, f"a dog number {k % 4} runs", None, None, 8, 8, "train")
        for k in range(60)
    ]
    captions = spark.createDataFrame(rows, CAPTIONS)
    tokens = captions.select("caption_id", F.split("caption", " ").alias("t"))
    predictions = jobs.predict(captions, V.build_vocabulary(tokens, "t"), PredictSettings()).collect()
    assert sorted(r["id"] for r in predictions) == list(range(60))
    hot = [r for r in predictions if r["image_id"] == 0]
    assert len(hot) == 41 and len({r["predicted_labels"] for r in hot}) == 1
    # Four numbers share the hot picture about evenly.
    assert all(math.log(3) < r["loss"] < math.log(6) for r in hot)


def test_loss_is_that_of_the_labels(spark):
    """Captions that differ behind the cut have one loss; the end mark after the cut counts."""
    words = " ".join(f"w{k}" for k in range(62))
    rows = [(0, "img/0.png", k, f"{words} {end}", None, None, 8, 8, "train") for k, end in enumerate(["x y", "z"])]
    rows.append((0, "img/0.png", 2, "w0 other", None, None, 8, 8, "train"))
    rows.append((1, "img/1.png", 3, None, None, None, 8, 8, "train"))
    captions = spark.createDataFrame(rows, CAPTIONS)
    tokens = captions.select(F.split(F.lower("caption"), " ").alias("t"))
    found = {r["id"]: r for r in jobs.predict(captions, V.build_vocabulary(tokens, "t"), PredictSettings()).collect()}
    # Only the step from w0 has two ways: three captions, two of which go on to w1.
    assert found[0]["loss"] == found[1]["loss"] == pytest.approx(math.log(3 / 2), abs=1e-5)
    assert found[0]["tokens"] == 63 and found[0]["labels"] == found[1]["labels"] == words
    assert found[2]["loss"] == pytest.approx(math.log(3), abs=1e-5) and found[2]["tokens"] == 3
    assert (found[3]["loss"], found[3]["tokens"], found[3]["labels"]) == (0.0, 1, "")


def test_eval_loss_is_the_mean_of_batches(spark, tmp_path):
    rows = [(0, 10.0, 10, "a", "a"), (1, 1.0, 2, "a", "b"), (2, 6.0, 3, "a", "a")]
    frame = spark.createDataFrame(rows, "id long, loss double, tokens long, predicted_labels string, labels string")
    settings = EvaluateSettings(output_dir=str(tmp_path), test_batch_size=2)
    record = jobs.run_evaluate(frame, settings, metrics=("bleu",)).first()
    assert record["eval_loss"] == pytest.approx((2 * 11 / 12 + 1 * 6 / 3) / 3) and record["n_tokens"] == 15


def test_model_of_other_captions(spark, captions):
    settings = PredictSettings(prompt_tokens=1, max_new_tokens=2)
    model = jobs.fit_tokens(captions.where("split = 'train'"), settings)
    tokens = captions.select(F.split(F.lower("caption"), " ").alias("t"))
    test = captions.where("split <> 'train'")
    found = {r["id"]: r for r in jobs.predict(test, V.build_vocabulary(tokens, "t"), settings, model).collect()}
    assert set(found) == {4, 5} and found[4]["predicted_labels"].startswith("a dog")
    # Nothing of "birds" was seen: two unseen steps.
    assert found[5]["loss"] == pytest.approx(2 * 13.815511) and found[5]["predicted_labels"] == "birds"


def test_null_texts_count_as_empty(spark):
    from capstan.operators.report import evaluate

    pairs = spark.createDataFrame([(1, "a b", "a b"), (2, None, "a"), (3, "a", None)], "id long, prediction string, reference string")
    empty = pairs.fillna("")
    assert evaluate(pairs).first().asDict() == evaluate(empty).first().asDict()
    assert evaluate(pairs).first()["n_pairs"] == 3


@pytest.mark.parametrize("values", [1, 3, 1 << 18])
def test_lookups_gather_no_list_of_a_part(spark, monkeypatch, values):
    """Entries meet their part as rows, in whatever order; parts without a value have none."""
    monkeypatch.setattr(V, "PART_VALUES", values)
    entries = [("a", 4), ("b", 5), ("c", 6)]
    vocabulary = spark.createDataFrame(entries, "token string, token_id int")
    texts = {1: ["a", "x", "c", "a"], 2: [], 3: None, 4: ["b", None, "c"], 5: [None], 6: ["y"], 7: ["c", "b", "a"]}
    df = spark.createDataFrame(list(texts.items()), "id long, tokens array<string>")
    ids = V.encode(df, "id", "tokens", vocabulary)
    assert "collect_list" not in ids._jdf.queryExecution().executedPlan().toString()
    known = dict(entries)
    wanted = {k: [known.get(t, V.UNK) for t in v or []] for k, v in texts.items()}
    assert {r["id"]: r["ids"] for r in ids.collect()} == wanted
    back = {i: t for t, i in entries}
    text = V.decode(ids, "id", "ids", vocabulary)
    assert {r["id"]: r["text"] for r in text.collect()} == {k: " ".join(back.get(i, "[UNK]") for i in v) for k, v in wanted.items()}
    none = spark.createDataFrame([(1, []), (2, None)], "id long, tokens array<string>")
    assert sorted(tuple(r) for r in V.encode(none, "id", "tokens", vocabulary).collect()) == [(1, []), (2, [])]
