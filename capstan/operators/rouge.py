"""ROUGE-1, ROUGE-2, ROUGE-L and ROUGE-Lsum (Lin 2004)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions.subsequence import lcs, summary_lcs
from capstan.operators.ngrams import overlap_wide


def f_measure(matches: Column, predicted: Column, expected: Column) -> Column:
    """2PR/(P+R), which is 2m/(p+e); 0 where a side is empty."""
    empty = (predicted == 0) | (expected == 0)
    return F.when(empty, 0.0).otherwise(2.0 * matches / (predicted + expected))


def rouge_n_rows(pairs: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """(id, groups, rouge1, rouge2) per pair."""
    wide = overlap_wide(pairs, group_cols, max_order=2)
    scores = [
        f_measure(F.col(f"matches_{n}"), F.col(f"predicted_{n}"), F.col(f"expected_{n}")).alias(f"rouge{n}")
        for n in (1, 2)
    ]
    return wide.select("id", *group_cols, *scores)


def rouge_l_column(prediction: str = "prediction", reference: str = "reference") -> Column:
    """ROUGE-L of one pair of token arrays; the pair never leaves its row."""
    return f_measure(lcs(prediction, reference), F.size(prediction), F.size(reference))


def flat_size(lines: Column | str) -> Column:
    return F.aggregate(lines, F.lit(0), lambda total, line: total + F.size(line))


def rouge_lsum_column(
    prediction_lines: str = "prediction_lines", reference_lines: str = "reference_lines"
) -> Column:
    """ROUGE-Lsum of one pair of arrays of token lines."""
    hits = summary_lcs(reference_lines, prediction_lines)
    return f_measure(hits, flat_size(prediction_lines), flat_size(reference_lines))


def mean_scores(rows: DataFrame, names: list[str], group_cols: list[str] = ()) -> DataFrame:
    """Corpus value: mean of the pair scores."""
    return rows.groupBy(*group_cols).agg(*[F.avg(name).alias(name) for name in names])
