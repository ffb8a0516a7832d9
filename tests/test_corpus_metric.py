"""A user's corpus metric against the same over one list."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from capstan.operators import corpus_metric as CM
from capstan.operators import report as R
from capstan.plans.user_metrics import CorpusBleu


class Spread:
    """Mean length of predictions and how many states were merged, as a number that depends on every pair."""

    def zero(self):
        return (0, 0, 0)

    def accumulate(self, state, predictions, references):
        n, total, differ = state
        differ += sum(p != r for p, r in zip(predictions, references, strict=True))
        return (n + len(predictions), total + sum(map(len, predictions)), differ)

    def merge(self, a, b):
        return tuple(x + y for x, y in zip(a, b, strict=True))

    def finish(self, state):
        n, total, differ = state
        return total / n + 1000 * differ if n else -1.0


def rows(n=400):
    texts = ["a b c d", "a b x d e", None, "", "the dog runs far", "the dog"]
    return [(i, "xyz"[i % 3] if i % 7 else None, texts[i % 6], texts[(i * 5) % 6]) for i in range(n)]


def frame(spark, data, partitions):
    return spark.createDataFrame(data, "id long, lang string, prediction string, reference string").repartition(partitions)


@pytest.mark.parametrize("fan_in", [2, 3, 100])
def test_states_merge_in_rounds(spark, monkeypatch, fan_in):
    monkeypatch.setattr(CM, "GROUPS_AT_ONCE", 2)
    data = rows()
    got = {r["lang"]: r["own"] for r in CM.corpus_metric(frame(spark, data, 13), Spread, ["lang"], "own", fan_in).collect()}
    metric = Spread()
    for lang in {r[1] for r in data}:
        some = [(p or "", q or "") for _, k, p, q in data if k == lang]
        assert got[lang] == pytest.approx(metric.finish(metric.accumulate(metric.zero(), *zip(*some))))
    assert len(got) == 4
    assert CM.corpus_metric(frame(spark, data, 5), Spread, [], "own", fan_in).count() == 1


def test_no_pairs(spark):
    empty = frame(spark, rows(1), 1).where("false")
    assert [tuple(r) for r in CM.corpus_metric(empty, Spread).collect()] == [(-1.0,)]
    assert CM.corpus_metric(empty, Spread, ["lang"]).count() == 0


def test_evaluate_takes_it_along(spark):
    pairs = frame(spark, rows(90), 4).withColumn("prediction", F.concat_ws(" ", "prediction", F.lit("a b c")))
    result = R.evaluate(pairs, ("bleu",), ["lang"], corpus_scores={"own_bleu": CorpusBleu, "spread": Spread})
    for r in result.collect():
        assert r["own_bleu"] == pytest.approx(r["score"]) and r["spread"] is not None


def test_user_bleu_of_a_list():
    metric = CorpusBleu()
    state = metric.accumulate(metric.zero(), ["a b c d", "x"], ["a b c d", "y"])
    assert Counter(state["total"]) == Counter({1: 5, 2: 3, 3: 2, 4: 1})
    halves = [metric.accumulate(metric.zero(), [p], [r]) for p, r in (("a b c d", "a b c d"), ("x", "y"))]
    assert metric.finish(metric.merge(*halves)) == metric.finish(state)
    assert metric.finish(metric.zero()) == 0.0 and not math.isnan(metric.finish(state))
