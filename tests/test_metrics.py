import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capstan.operators import bleu as B
from capstan.operators import meteor as M
from capstan.operators import ngrams as N
from capstan.operators import report as R
from capstan.operators import rouge as RG
from capstan.operators.bootstrap import bootstrap_mean

# Published sums and scores: correct, total, sys_len, ref_len, score 0..100.
GOLDEN = [
    ([5353, 2245, 954, 477], [10740, 9740, 8740, 7740], 10740, 11987, 14.845372889809905),
    ([5289, 2216, 925, 464], [10709, 9709, 8709, 7709], 10709, 11987, 14.541195244037787),
    ([6013, 2574, 1113, 542], [13002, 12002, 11002, 10002], 13002, 12193, 15.270138656859801),
]
# Published precisions of the ratio form: precisions, lengths, bleu.
GOLDEN_RATIO = [
    ([0.3914987919173887, 0.13178894294736912, 0.0556269031931807, 0.02790040543839778], 324895, 282530, 0.09459674644216093),
    ([0.3756299519278358, 0.13535894282476066, 0.05933713959776451, 0.029570866467069676], 232359, 282141, 0.07844469436156895),
]


def state(spark, correct, total, sys_len, ref_len):
    values = {f"correct_{n}": c for n, c in enumerate(correct, 1)}
    values |= {f"total_{n}": t for n, t in enumerate(total, 1)}
    values |= {"sys_len": sys_len, "ref_len": ref_len, "n_pairs": 1}
    return spark.createDataFrame([values])


@pytest.mark.parametrize("correct,total,sys_len,ref_len,score", GOLDEN)
def test_published_scores(spark, correct, total, sys_len, ref_len, score):
    row = B.finish_bleu(state(spark, correct, total, sys_len, ref_len)).first()
    assert row["score"] == pytest.approx(score, rel=1e-14)
    assert row["counts"] == correct and row["totals"] == total


@pytest.mark.parametrize("precisions,sys_len,ref_len,score", GOLDEN_RATIO)
def test_published_ratio_scores(spark, precisions, sys_len, ref_len, score):
    scale = 10**15
    correct = [round(p * scale) for p in precisions]
    row = B.ratio_form(B.finish_bleu(state(spark, correct, [scale] * 4, sys_len, ref_len))).first()
    assert row["bleu"] == pytest.approx(score, rel=1e-12)
    assert row["length_ratio"] == sys_len / ref_len


def test_floor_and_empty_rules(spark):
    row = B.finish_bleu(state(spark, [3, 1, 0, 0], [4, 3, 2, 1], 4, 4)).first()
    assert row["precisions"] == pytest.approx([75.0, 100 / 3, 5.0, 10.0])
    assert row["score"] == pytest.approx(math.exp(sum(map(math.log, [75.0, 100 / 3, 5.0, 10.0])) / 4))
    assert B.finish_bleu(state(spark, [0, 0, 0, 0], [4, 3, 2, 1], 4, 4)).first()["score"] == 0.0
    assert B.finish_bleu(state(spark, [2, 1, 0, 0], [2, 1, 0, 0], 2, 4)).first()["score"] == 0.0
    none = B.finish_bleu(state(spark, [0] * 4, [0] * 4, 0, 4)).first()
    assert (none["bp"], none["score"]) == (0.0, 0.0)


def pairs_frame(spark, rows, partitions=3):
    df = spark.createDataFrame(
        [(i, h, r) for i, (h, r) in enumerate(rows)], "id long, prediction array<string>, reference array<string>"
    )
    return df.repartition(partitions)


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


token_rows = st.lists(st.sampled_from(["a", "b", "c", "a b"]), max_size=9)
pair_rows = st.lists(st.tuples(token_rows, token_rows), min_size=1, max_size=6)


@settings(max_examples=6, deadline=None)
@given(pair_rows)
def test_overlap_matches_counters(spark, rows):
    wide = {r["id"]: r for r in N.overlap_wide(pairs_frame(spark, rows)).collect()}
    assert set(wide) == set(range(len(rows)))
    for i, (h, r) in enumerate(rows):
        for n in range(1, 5):
            common = sum((grams(h, n) & grams(r, n)).values())
            assert wide[i][f"matches_{n}"] == common
            assert wide[i][f"predicted_{n}"] == max(0, len(h) - n + 1)
            assert wide[i][f"expected_{n}"] == max(0, len(r) - n + 1)


def test_states_add_up(spark):
    rows = [(list("abcab"), list("abcaa")), (list("ab"), list("ba")), ([], list("abc")), (list("cccc"), list("cc"))]
    pairs = pairs_frame(spark, rows).withColumn("batch", F.col("id") % 3)
    whole = B.bleu_state(pairs).first().asDict()
    merged = B.merge_states(B.bleu_state(pairs, ["batch"])).first().asDict()
    assert merged == whole
    assert whole["n_pairs"] == 4


def test_identical_and_disjoint(spark):
    same = pairs_frame(spark, [(list("abcdef"), list("abcdef"))])
    assert B.bleu(same).first()["score"] == pytest.approx(100.0)
    row = RG.rouge_n_rows(same).first()
    assert (row["rouge1"], row["rouge2"]) == (1.0, 1.0)
    apart = pairs_frame(spark, [(list("abc"), list("xyz")), ([], []), (list("a"), [])])
    for row in RG.rouge_n_rows(apart).collect():
        assert (row["rouge1"], row["rouge2"]) == (0.0, 0.0)


def test_rouge_l_by_hand(spark):
    # Example of the paper: "police kill the gunman" against two candidates.
    reference = "police killed the gunman".split()
    pairs = pairs_frame(spark, [("police kill the gunman".split(), reference), ("the gunman kill police".split(), reference)])
    scores = {r["id"]: r["f"] for r in pairs.select("id", RG.rouge_l_column().alias("f")).collect()}
    assert scores == {0: 0.75, 1: 0.5}


def test_rouge_lsum_by_hand(spark):
    # Union example of the paper: w1 w2 w3 w4 w5 against two lines: 4 hits.
    df = spark.createDataFrame(
        [([["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]], [["w1", "w2", "w3", "w4", "w5"]])],
        "prediction_lines array<array<string>>, reference_lines array<array<string>>",
    )
    assert df.select(RG.rouge_lsum_column()).first()[0] == pytest.approx(2 * 4 / 15)


def test_meteor_by_hand(spark):
    rows = [
        ("the cat sat on the mat".split(), "on the mat sat the cat".split()),
        ("The cats".split(), "the cat".split()),
        (["x"], ["y"]),
        ([], ["y"]),
    ]
    pairs = pairs_frame(spark, rows)
    out = {r["id"]: r for r in M.meteor_rows(pairs).collect()}
    # "the" pairs last with last, so no two neighbours stay neighbours: the known 0.5.
    assert (out[0]["matches"], out[0]["chunks"]) == (6, 6)
    assert out[0]["meteor"] == pytest.approx(0.5)
    assert (out[1]["matches"], out[1]["chunks"]) == (2, 1)
    assert out[2]["meteor"] == 0.0 and out[3]["meteor"] == 0.0
    assert {r["id"]: r["matches"] for r in M.meteor_rows(pairs, stems=False).collect()}[1] == 1
    assert pairs.select("id", M.meteor_column().alias("m")).where("id = 0").first()["m"] == out[0]["meteor"]


def test_meteor_synonyms(spark):
    pairs = pairs_frame(spark, [(["big", "dog"], ["large", "dog"]), ([], ["dog"])])
    lexicon = spark.createDataFrame([("big", "s1"), ("large", "s1"), ("large", "s2")], "word string, synset string")
    out = {r["id"]: r for r in M.meteor_rows(pairs, synsets=lexicon).collect()}
    assert (out[0]["matches"], out[0]["chunks"]) == (2, 1)
    assert out[1]["matches"] == 0


def test_report(spark):
    text = spark.createDataFrame(
        [(1, "en", "a dog runs\nfast", "a dog runs\nfast"), (2, "de", "ein Hund", "zwei Katzen"), (3, None, "x y", "x y")],
        "id long, lang string, prediction string, reference string",
    )
    out = {r["lang"]: r for r in R.evaluate(text, group_cols=["lang"]).collect()}
    assert out["en"]["score"] == pytest.approx(100.0)
    assert out["en"]["rougeL"] == out["en"]["rougeLsum"] == out["en"]["rouge1"] == 1.0
    assert out["de"]["rouge1"] == 0.0 and out["de"]["meteor"] == 0.0
    assert out[None]["rouge2"] == 1.0
    one = R.evaluate(text).first()
    assert one["n_pairs"] == 3 and one["rouge1"] == pytest.approx(2 / 3)
    few = R.evaluate(text, metrics=("rougeL", "meteor")).first().asDict()
    assert set(few) == {"n_pairs", "rougeL", "meteor"}
    tokens = R.tokenized(text, ["lang"])
    states = R.metric_state(tokens, R.METRICS, ["lang"])
    merged = R.finish_metrics(R.merge_metric_states(states)).first().asDict()
    assert {k: pytest.approx(v) for k, v in one.asDict().items()} == merged


def test_bootstrap(spark):
    rows = spark.range(300).select(F.col("id"), (F.col("id") % 7 / 7.0).alias("v"))
    results = [bootstrap_mean(rows.repartition(p), "id", "v", seed=1, resamples=400).first() for p in (1, 5)]
    assert results[0]["mid"] == pytest.approx(results[1]["mid"], rel=1e-12)
    row = results[0]
    assert row["low"] < row["mean"] < row["high"]
    # The interval of a mean of 300 values with deviation 2/7 is about 0.065 wide.
    assert 0.05 < row["high"] - row["low"] < 0.08
    assert abs(row["mid"] - row["mean"]) < 0.01
    other = bootstrap_mean(rows, "id", "v", seed=2, resamples=400).first()
    assert other["mid"] != row["mid"] and other["mean"] == row["mean"]
