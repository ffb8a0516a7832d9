import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capstan.functions import labels as L
from capstan.functions import text as X
from capstan.operators import vocabulary as V


def one(spark, column, **values):
    names = list(values)
    types = {int: "int", str: "string", list: "array<int>"}
    schema = ", ".join(f"{n} {types[type(values[n])]}" for n in names)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_pad_branch_masks_every_pad(spark):
    # The true end token equals PAD here, so it is masked as well.
    assert one(spark, L.make_labels("ids", 5, 9), ids=[4, 9, 5]) == [4, -100, 5, -100, -100]


def test_nopad_branch_keeps_end(spark):
    assert one(spark, L.make_labels("ids", 5, None), ids=[4, 9, 5]) == [4, 9, 5, -100, -100]


def test_exact_and_over_length(spark):
    assert one(spark, L.make_labels("ids", 3, 0), ids=[4, 5, 6]) == [4, 5, 6]
    assert one(spark, L.make_labels("ids", 2, 0), ids=[4, 5, 6]) == [4, 5]
    assert one(spark, L.make_labels("ids", 2, 0), ids=[]) == [-100, -100]


def test_wrong_length_fails(spark):
    with pytest.raises(Exception, match="labels must have 4 entries, found 2"):
        one(spark, L.checked_labels("ids", 4), ids=[1, 2])


def test_special_tokens_count(spark):
    assert one(spark, L.add_special("ids", 4, 2, 3), ids=[7, 8, 9]) == [2, 7, 8, 3]
    assert one(spark, L.add_special("ids", 4, None, 3), ids=[7, 8, 9]) == [7, 8, 9, 3]


def test_unmask(spark):
    assert one(spark, L.unmask("ids", 0), ids=[4, -100]) == [4, 0]
    assert one(spark, L.unmask("ids", None, 50256), ids=[4, -100]) == [4, 50256]


def test_drop_special_and_count(spark):
    assert one(spark, L.drop_special("ids", [0, 2, 3]), ids=[2, 7, -100, 3, 0]) == [7]
    assert one(spark, L.token_count("ids", 0), ids=[7, 0, 8]) == 2


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(1, 50), max_size=9), min_size=1, max_size=8))
def test_mask_round_trip(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, ids array<int>")
    out = df.select("ids", L.unmask(L.make_labels("ids", 6, 0), 0).alias("back")).collect()
    for row in out:
        assert row["back"] == (row["ids"] + [0] * 6)[:6]


def test_tokenizers(spark):
    text = "  Ein Hund,\trennt\x1fweg. "
    assert one(spark, X.tokenize("t"), t=text) == ["Ein", "Hund,", "rennt", "weg."]
    assert one(spark, X.tokenize("t", "word"), t=text) == ["Ein", "Hund", ",", "rennt", "weg", "."]
    assert one(spark, X.tokenize("t", "char"), t="犬が 走る😀") == ["犬", "が", "走", "る", "😀"]
    assert one(spark, X.tokenize("t"), t="") == []
    with pytest.raises(ValueError):
        X.tokenize("t", "subword")


def test_subword_files(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = tokenizers.path(name)
        df = spark.createDataFrame([("a dog runs",), ("",), (None,)], "t string")
        ids = df.withColumn("ids", X.subword_ids("t", path))
        rows = ids.select(X.subword_text(F.concat("ids", F.array(F.lit(-100))), path).alias("back"), F.size("ids").alias("n")).collect()
        assert rows[0]["back"].strip() == "a dog runs"
        assert rows[0]["n"] >= 3 and rows[1]["n"] == 0 and rows[2]["n"] == 0
        pieces = df.select(X.tokenize("t", "subword", path).alias("p")).first()["p"]
        assert len(pieces) == rows[0]["n"]


def test_vocabulary_round_trip(spark, monkeypatch):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, ["c", "b", "a", "zz"]), (4, None)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    vocabulary = V.build_vocabulary(df, "tokens")
    ranked = {r["token"]: (r["token_id"], r["n"]) for r in vocabulary.collect()}
    assert ranked == {"b": (4, 3), "a": (5, 2), "c": (6, 1), "zz": (7, 1)}
    assert {r["token"]: r["token_id"] for r in V.special_tokens(vocabulary).collect()}["[SEP]"] == 3
    small = V.build_vocabulary(df, "tokens", max_size=2)
    # All rows of a task share a dictionary, then each row has its own.
    for values in (10_000, 1):
        monkeypatch.setattr(V, "PART_VALUES", values)
        ids = {r["id"]: r["ids"] for r in V.encode(df, "id", "tokens", vocabulary).collect()}
        assert ids == {1: [4, 5, 4], 2: [], 3: [6, 4, 5, 7], 4: []}
        cut = {r["id"]: r["ids"] for r in V.encode(df, "id", "tokens", small).collect()}
        assert cut[3] == [V.UNK, 4, 5, V.UNK]
        coded = spark.createDataFrame([(1, [2, 4, 5, 3, 0, -100]), (2, [6, 99])], "id long, ids array<int>")
        text = {r["id"]: r["text"] for r in V.decode(coded, "id", "ids", vocabulary).collect()}
        assert text == {1: "b a", 2: "c [UNK]"}


def test_values_stay_in_their_part(spark):
    """Null values, repeated keys and many rows; texts are not shuffled, and one row per different value is."""
    rows = [(k % 50, [f"w{(k * j) % 17}" if (k + j) % 9 else None for j in range(k % 13)]) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>").repartition(3)
    vocabulary = V.build_vocabulary(df.select(F.array_compact("tokens").alias("tokens")), "tokens", max_size=9)
    ids = {r["token"]: r["token_id"] for r in vocabulary.collect()}
    made = V.encode(df, "id", "tokens", vocabulary)
    assert made._jdf.queryExecution().executedPlan().toString().count("Generate") == 1
    assert sorted((r["id"], r["ids"]) for r in made.collect()) == sorted((i, [ids.get(t, V.UNK) for t in ts]) for i, ts in rows)
    assert V.encode(df.where("false"), "id", "tokens", vocabulary).count() == 0
