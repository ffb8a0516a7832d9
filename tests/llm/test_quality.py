"""The classifier on held-out labels, and its gradient against differences."""

import numpy as np
from pyspark.sql import functions as F

from capstan.llm import quality
from tests.llm.fixtures import awkward, table


def test_held_out_accuracy(spark):
    """Fitted on half the labels; the other half is graded."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rated = quality.grade_of_labels(spark.read.parquet(f"{folder}/labels.parquet"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2))
    made = quality.quality(docs, rated.where(half == 0)).join(rated.where(half == 1), "doc_id").collect()
    good = [r for r in made if r.grade == 2]
    assert np.mean([r.keep for r in good]) > 0.95
    assert np.mean([r.keep == (r.grade == 2) for r in made]) > 0.88
    assert np.mean([r.expected_grade for r in good]) > np.mean([r.expected_grade for r in made if r.grade < 2]) + 0.5


def loss(rows, grades, model):
    out = 0.0
    for (buckets, values), grade in zip(rows, grades, strict=True):
        above = np.concatenate([[1.0], model.above(buckets, values), [0.0]])
        out -= np.log(above[grade] - above[grade + 1])
    return out / len(rows)


def test_fit_lowers_the_loss_and_orders_the_thresholds():
    features = quality.Features()
    texts = ["bad awful words", "so so words", "good fine words"] * 10
    grades = np.array([0, 1, 2] * 10)
    rows = [features(t) for t in texts]
    fitted = quality.fit(rows, grades, 2)
    assert fitted.thresholds[0] < fitted.thresholds[1]
    start = quality.Ordinal(np.zeros(quality.BUCKETS), fitted.thresholds)
    assert loss(rows, grades, fitted) < 0.3 < loss(rows, grades, start)
    for k, text in enumerate(texts[:3]):
        assert abs(fitted.above(*features(text)).sum() - k) < 0.5


def test_one_grade_alone(spark):
    features = quality.Features()
    only = quality.fit([features("a b"), features("c")], np.array([2, 2]), 2)
    assert only.above(*features("d"))[-1] > 0.5
    assert quality.fit([], np.zeros(0, np.int64), 2).above(*features("d"))[-1] > 0.99


def test_awkward_rows(spark):
    docs = table(spark, awkward())
    ratings = spark.createDataFrame([(4, 2), (5, 2), (7, 0), (7, 2), (None, 1), (8, None)], "doc_id long, grade int")
    made = quality.with_quality(docs, ratings)
    assert made.columns == [c for c in docs.columns if c != "keep"] + ["expected_grade", "p_top", "keep"]
    rows = made.collect()
    assert len(rows) == len(awkward()) and all(0 <= r.p_top <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert all(r.keep == (r.p_top >= quality.LEAST) for r in rows)
    assert quality.quality(docs, ratings).count() == sum(i is not None for i, _ in awkward())
    # Nothing rated: nothing is rejected.
    assert all(r.keep for r in quality.with_quality(docs, ratings.limit(0)).collect())
    assert quality.with_quality(table(spark, []), ratings).count() == 0


def test_grades_of_labels(spark):
    rows = [(1, 1, 1), (2, 0, 1), (3, 0, 0), (4, 1, 0), (5, None, 0), (6, 1, None), (7, None, 1), (8, 0, None)]
    made = quality.grade_of_labels(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert {r.doc_id: r.grade for r in made.collect()} == {1: 0, 2: 0, 3: 1, 4: 2, 5: None, 6: None, 7: 0, 8: 1}


def test_sample_is_bounded_and_lowest_of_several_grades_holds(spark):
    docs = spark.createDataFrame([(i, f"w{i} text") for i in range(50)], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, i % 3) for i in range(50)], "doc_id long, grade int")
    small = quality.train(docs, ratings, 2, sample=5)
    assert 0 < np.count_nonzero(small.weights) < np.count_nonzero(quality.train(docs, ratings, 2).weights)


def test_the_whole_of_long_tokens_counts():
    """Texts without spaces differ far behind their first characters."""
    rng = np.random.default_rng(3)
    filler = ["".join(chr(0x4E00 + c) for c in rng.integers(0, 3000, 400)) for _ in range(240)]
    bad = "毒毒惡語"
    texts = [t[:300] + bad + t[300:] if i % 2 else t for i, t in enumerate(filler)]
    features = quality.Features()
    rows = [features(t) for t in texts]
    grades = np.array([0 if i % 2 else 2 for i in range(240)])
    fitted = quality.fit(rows[:200], grades[:200], 2)
    top = np.array([fitted.above(*r)[-1] for r in rows[200:]])
    assert top[1::2].max() < top[::2].min()
    long = "x" * 70 + "Y9!"
    assert set(quality.Features()("a b")[0]) <= set(quality.Features()("a b " + long)[0]) and len(features(long)[0]) > 5


def test_repeated_rows_of_a_rated_document_count_once(spark):
    rows = [(i, f"w{i % 5} text {i}") for i in range(30)] + [(3, "w3 text 3")] * 40
    ratings = spark.createDataFrame([(i, i % 3) for i in range(30)], "doc_id long, grade int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    once = quality.train(docs.dropDuplicates(), ratings, 2)
    assert np.array_equal(quality.train(docs, ratings, 2).weights, once.weights)


def test_a_fit_by_parts_is_the_fit(monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 500, n).astype(np.int32), rng.random(n).astype(np.float32)) for n in [0, 3, 50, 1, 0, 200, 7, 0]]
    grades = np.array([0, 1, 2, 2, 1, 0, 2, 1])
    whole = quality.fit(rows, grades, 2)
    monkeypatch.setattr(quality, "AT_ONCE", 40)
    parts = quality.fit(rows, grades, 2)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.thresholds, parts.thresholds)
