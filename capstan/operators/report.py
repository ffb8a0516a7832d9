"""All corpus metrics of (prediction, reference) pairs from one additive state."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions.text import tokenize, tokenize_lines
from capstan.operators.bleu import finish_bleu
from capstan.operators.corpus_metric import CorpusMetric, corpus_metric
from capstan.operators.meteor import meteor_column
from capstan.operators.ngrams import MAX_ORDER, overlap_wide
from capstan.operators.rouge import f_measure, rouge_l_column, rouge_lsum_column

METRICS = ("bleu", "rouge1", "rouge2", "rougeL", "rougeLsum", "meteor")
NGRAM_STATE = [f"{what}_{n}" for n in range(1, MAX_ORDER + 1) for what in ("correct", "total")]
NGRAM_STATE += ["sys_len", "ref_len"]


def tokenized(
    pairs: DataFrame,
    group_cols: list[str] = (),
    tokenizer: str = "whitespace",
    path: str | None = None,
) -> DataFrame:
    """Text pairs to token arrays and, for the summary metric, token lines; a null text counts as empty."""
    columns = []
    for side in ("prediction", "reference"):
        text = F.coalesce(F.col(side), F.lit(""))
        columns.append(tokenize(text, tokenizer, path).alias(side))
        columns.append(tokenize_lines(text, tokenizer, path).alias(f"{side}_lines"))
    return pairs.select("id", *group_cols, *columns)


def by_groups(frames: list[DataFrame], group_cols: list[str] = ()) -> DataFrame:
    """Put aggregates of the same groups side by side; later columns win.

    Rows of one group are stacked and folded, so no join is needed and a null
    group meets itself.
    """
    if len(frames) == 1:
        return frames[0]
    parts = []
    for number, frame in enumerate(frames):
        later = {c for other in frames[number + 1 :] for c in other.columns}
        parts.append(frame.drop(*[c for c in frame.columns if c in later and c not in group_cols]))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for part in parts for c in part.columns if c not in group_cols]
    return stacked.groupBy(*group_cols).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def metric_state(
    tokens: DataFrame, metrics: tuple[str, ...] = METRICS, group_cols: list[str] = ()
) -> DataFrame:
    """Sums per group that add up over disjoint batches of pairs.

    Grams are counted once for BLEU and both n-gram ROUGE scores; the pair
    scores of subsequences and alignment are taken row by row without a shuffle.
    """
    group_cols = list(group_cols)
    frames = []
    if {"bleu", "rouge1", "rouge2"} & set(metrics):
        wide = overlap_wide(tokens, group_cols, MAX_ORDER if "bleu" in metrics else 2)
        sums = [F.count(F.lit(1)).alias("n_pairs")]
        if "bleu" in metrics:
            for n in range(1, MAX_ORDER + 1):
                sums += [
                    F.sum(f"matches_{n}").alias(f"correct_{n}"),
                    F.sum(f"predicted_{n}").alias(f"total_{n}"),
                ]
            sums += [F.sum("predicted_1").alias("sys_len"), F.sum("expected_1").alias("ref_len")]
        for n in (1, 2):
            if f"rouge{n}" in metrics:
                score = f_measure(F.col(f"matches_{n}"), F.col(f"predicted_{n}"), F.col(f"expected_{n}"))
                sums.append(F.sum(score).alias(f"rouge{n}_sum"))
        frames.append(wide.groupBy(*group_cols).agg(*sums))
    if {"rougeL", "rougeLsum", "meteor"} & set(metrics):
        frames.append(row_score_sums(tokens, metrics, group_cols))
    return by_groups(frames, group_cols)


def row_score_sums(tokens: DataFrame, metrics: tuple[str, ...], group_cols: list[str]) -> DataFrame:
    """Sums of the pair scores that need a whole row, all from one pass."""
    scores = []
    if "rougeL" in metrics:
        scores.append(rouge_l_column().alias("rougeL"))
    if "rougeLsum" in metrics:
        scores.append(rouge_lsum_column().alias("rougeLsum"))
    if "meteor" in metrics:
        scores.append(meteor_column().alias("meteor"))
    names = [c for c in ("rougeL", "rougeLsum", "meteor") if c in metrics]
    rows = tokens.select(*group_cols, *scores)
    sums = [F.sum(c).alias(f"{c}_sum") for c in names]
    return rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_pairs"), *sums)


def merge_metric_states(states: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Add stored states of disjoint batches."""
    sums = [c for c in states.columns if c in NGRAM_STATE or c == "n_pairs" or c.endswith("_sum")]
    return states.groupBy(*group_cols).agg(*[F.sum(c).alias(c) for c in sums])


def finish_metrics(state: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """One record per group: BLEU fields, mean scores, number of pairs."""
    means = [
        (F.col(c) / F.col("n_pairs")).alias(c.removesuffix("_sum"))
        for c in state.columns
        if c.endswith("_sum")
    ]
    if "sys_len" in state.columns:
        return finish_bleu(state, group_cols, more=[F.col("n_pairs"), *means])
    return state.select(*group_cols, "n_pairs", *means)


def evaluate(
    pairs: DataFrame,
    metrics: tuple[str, ...] = METRICS,
    group_cols: list[str] = (),
    tokenizers: dict[str, str] | None = None,
    path: str | None = None,
    scores: dict[str, Callable[[Column, Column], Column]] | None = None,
    corpus_scores: dict[str, Callable[[], CorpusMetric]] | None = None,
) -> DataFrame:
    """Metrics of text pairs (id, prediction, reference), one record per group.

    ``tokenizers`` names one for each of bleu, rouge and meteor; metrics that
    share a tokenizer share their passes over the pairs. ``scores`` are a user's
    own: a name and a function of a pair's two texts, averaged over the pairs.
    ``corpus_scores`` are a user's own too, of all pairs of a group: a name and a
    factory of a :class:`CorpusMetric`.
    """
    tokenizers = {"bleu": "whitespace", "rouge": "whitespace", "meteor": "whitespace"} | (tokenizers or {})
    by_kind: dict[str, list[str]] = {}
    for metric in metrics:
        family = "rouge" if metric.startswith("rouge") else metric
        by_kind.setdefault(tokenizers[family], []).append(metric)
    states = [
        metric_state(tokenized(pairs, group_cols, kind, path), tuple(names), group_cols)
        for kind, names in by_kind.items()
    ]
    result = finish_metrics(by_groups(states, group_cols), group_cols)
    frames = [result]
    if scores:
        texts = [F.coalesce(F.col(side), F.lit("")) for side in ("prediction", "reference")]
        means = [F.avg(score(*texts).cast("double")).alias(name) for name, score in scores.items()]
        frames.append(pairs.groupBy(*group_cols).agg(*means))
    frames += [corpus_metric(pairs, make, group_cols, name) for name, make in (corpus_scores or {}).items()]
    return by_groups(frames, group_cols)
