"""Beam search and losses by a model that scores batches of sequences."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.functions.labels import IGNORED
from capstan.operators import generation as G
from capstan.session import Scratch, bucketed

# A model's scores of the next token, one row per sequence and one column per
# token id, from the rows' features and their token ids so far. Minus infinity
# forbids a token.
Model = Callable[[np.ndarray, list[np.ndarray]], np.ndarray]

BATCH = 64


def log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores.astype(np.float64)
    top = scores.max(axis=1, keepdims=True)
    return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))


def forbidden(seq: np.ndarray, size: int) -> np.ndarray:
    """Tokens that would repeat a gram of ``size`` tokens of the sequence; none for size 0."""
    if size <= 0 or len(seq) < size:
        return seq[:0]
    tail = seq[len(seq) - size + 1 :]
    grams = np.lib.stride_tricks.sliding_window_view(seq, size)
    return grams[(grams[:, : size - 1] == tail).all(axis=1), size - 1]


def best_tokens(logp: np.ndarray, width: int) -> list[list[dict]]:
    """Per row the ``width`` likeliest tokens as (next, logp in whole millionths), ties to the smaller id."""
    out = []
    units = np.where(np.isfinite(logp), np.floor(logp * G.SCORE_UNIT + 0.5), -np.inf)
    for row in units:
        if len(row) > width:
            least = np.partition(row, len(row) - width)[len(row) - width]
            able = np.nonzero((row >= least) & (row > -np.inf))[0]
        else:
            able = np.nonzero(row > -np.inf)[0]
        first = able[np.argsort(-row[able], kind="stable")[:width]]
        out.append([{"next": t, "logp": x} for t, x in zip(first.tolist(), row[first].astype(np.int64).tolist(), strict=True)])
    return out


def _features(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def _successors(
    beams: DataFrame, make_model: Callable[[], Model], feature_col: str, width: int, no_repeat_size: int, batch_size: int
) -> DataFrame:
    """Beams with the ``width`` best allowed successors that the model gives them.

    The model sees ``batch_size`` beams at a time; only the best tokens of each
    come back, not its scores of the whole vocabulary.
    """
    kept = [f for f in beams.schema if f.name != feature_col]
    entry = T.StructType([T.StructField("next", T.IntegerType()), T.StructField("logp", T.LongType())])
    schema = T.StructType([*kept, T.StructField("successors", T.ArrayType(entry))])
    arrow_entry = pa.list_(pa.struct([("next", pa.int32()), ("logp", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                seqs = [np.array(s, np.int64) for s in part.column("seq").to_pylist()]
                logp = log_softmax(model(_features(part.column(feature_col)), seqs))
                for row, seq in zip(logp, seqs, strict=True):
                    row[forbidden(seq, no_repeat_size)] = -np.inf
                columns = [part.column(f.name) for f in kept]
                columns.append(pa.array(best_tokens(logp, width), arrow_entry))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return beams.mapInArrow(run, schema)


def model_search(
    features: DataFrame,
    starts: DataFrame,
    by: list[str],
    make_model: Callable[[], Model],
    end: int,
    num_beams: int = G.NUM_BEAMS,
    max_new_tokens: int = G.MAX_NEW_TOKENS,
    no_repeat_size: int = G.NO_REPEAT_SIZE,
    feature_col: str = "features",
    batch_size: int = BATCH,
) -> DataFrame:
    """(by, seq, score, length): the best continuation of each start under a model.

    ``features`` is (by, feature_col) with one row per key, arrays of one length;
    ``starts`` is (by, seq) with token ids, none empty. ``make_model`` runs once
    per task. The search is that of :func:`generation.beam_search`: scores are
    whole millionths of a log probability, a key stops once ``num_beams``
    hypotheses have reached the token ``end``.

    Features are bucketed by key once, so that a step moves the live beams
    alone. A key without features has no row; one with several rows of them is
    refused.
    """
    with Scratch(starts.sparkSession) as work:
        live = G.start_beams(work, starts.select(*by, F.col("seq").cast("array<int>").alias("seq")), by)
        rows = features.select(*by, feature_col)
        with bucketed(rows, "features", rows.count(), *by) as placed:
            if not placed.groupBy(*by).count().where("count > 1").isEmpty():
                raise ValueError("several rows of features for one key")

            def step(live: DataFrame, alive: int) -> DataFrame:
                beams = live.hint("merge").join(placed, by)
                formed = _successors(beams, make_model, feature_col, 2 * num_beams, no_repeat_size, batch_size)
                return G.kept_beams(formed, by, num_beams, end)

            return G.search(work, live, by, step, num_beams, max_new_tokens)


def sequence_losses(
    rows: DataFrame,
    make_model: Callable[[], Model],
    key: str,
    labels: str = "labels",
    feature_col: str = "features",
    batch_size: int = BATCH,
) -> DataFrame:
    """(key, loss, tokens): summed loss of each row's labels under the model, given those before.

    The first label is what the model starts from; ignored labels are passed
    over. Prefixes go to the model ``batch_size`` at a time, so long labels need
    no more memory than short ones.
    """
    key_field = rows.schema[key]
    schema = T.StructType([key_field, T.StructField("loss", T.DoubleType()), T.StructField("tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in batches:
            ids = [np.array([x for x in s if x != IGNORED], np.int64) for s in batch.column(labels).to_pylist()]
            places = [(i, n) for i, s in enumerate(ids) for n in range(1, len(s))]
            losses: list[list[float]] = [[] for _ in ids]
            for start in range(0, len(places), batch_size):
                some = places[start : start + batch_size]
                taken = batch.column(feature_col).take(pa.array([i for i, _ in some]))
                logp = log_softmax(model(_features(taken), [ids[i][:n] for i, n in some]))
                for (i, n), row in zip(some, logp, strict=True):
                    losses[i].append(-row[ids[i][n]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([math.fsum(x) for x in losses], pa.float64()), pa.array([len(x) for x in losses], pa.int64())],
                names=schema.names,
            )

    return rows.select(key, labels, feature_col).mapInArrow(run, schema)
