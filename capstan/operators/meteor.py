"""METEOR per pair and as a corpus mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions.alignment import alignment, meteor_score


def _lowered(tokens: str) -> Column:
    return F.transform(tokens, lambda t: F.lower(t))


def meteor_column(prediction: str = "prediction", reference: str = "reference") -> Column:
    """Score of one pair of token arrays by the exact and stem stages."""
    aligned = alignment(_lowered(prediction), _lowered(reference))
    return meteor_score(
        aligned["matches"], aligned["chunks"], F.size(prediction), F.size(reference)
    )


def attach_senses(pairs: DataFrame, synsets: DataFrame, side: str) -> DataFrame:
    """(id, <side>_senses): for each token the synonym sets of (word, synset).

    A plain left join on the word: Spark broadcasts a small lexicon by itself
    and shuffles a large one.
    """
    tokens = pairs.select("id", F.posexplode(side).alias("pos", "word"))
    joined = tokens.join(synsets, "word", "left")
    per_token = joined.groupBy("id", "pos").agg(F.collect_set("synset").alias("senses"))
    per_pair = per_token.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "senses"))).alias("e")
    )
    return per_pair.select("id", F.transform("e", lambda e: e["senses"]).alias(f"{side}_senses"))


def meteor_rows(
    pairs: DataFrame,
    group_cols: list[str] = (),
    stems: bool = True,
    synsets: DataFrame | None = None,
) -> DataFrame:
    """(id, groups, matches, chunks, predicted, expected, meteor) per pair.

    ``pairs`` has ``id`` and the token arrays ``prediction`` and ``reference``.
    Without ``synsets`` nothing is shuffled.
    """
    low = pairs.select(
        "id",
        *group_cols,
        _lowered("prediction").alias("prediction"),
        _lowered("reference").alias("reference"),
    )
    senses = None
    if synsets is not None:
        empty = F.array().cast("array<array<string>>")
        for side in ("prediction", "reference"):
            low = low.join(attach_senses(low, synsets, side), "id", "left").withColumn(
                f"{side}_senses", F.coalesce(f"{side}_senses", empty)
            )
        senses = ("prediction_senses", "reference_senses")
    counted = low.select(
        "id",
        *group_cols,
        alignment("prediction", "reference", stems, senses).alias("a"),
        F.size("prediction").alias("predicted"),
        F.size("reference").alias("expected"),
    ).select("id", *group_cols, "a.matches", "a.chunks", "predicted", "expected")
    score = meteor_score(F.col("matches"), F.col("chunks"), F.col("predicted"), F.col("expected"))
    return counted.withColumn("meteor", score)
