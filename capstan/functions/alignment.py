"""METEOR alignment of two token rows, inside an Arrow UDF."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from capstan.functions.slices import by_slices
from capstan.functions.stemming import stem

# Fixed values of the score (Banerjee and Lavie 2005, later parameters).
ALPHA = 0.9
BETA = 3.0
GAMMA = 0.5


def _pair(left: dict, right: dict) -> list[tuple[int, int]]:
    """Pair equal keys, last with last, and take the paired positions away."""
    free = defaultdict(list)
    for position in sorted(right):
        free[right[position]].append(position)
    pairs = []
    for position in sorted(left, reverse=True):
        waiting = free.get(left[position])
        if waiting:
            pairs.append((position, waiting.pop()))
    for a, b in pairs:
        del left[a]
        del right[b]
    return pairs


def _pair_senses(left: dict, right: dict) -> list[tuple[int, int]]:
    """Pair positions that share a sense, the last free one first."""
    free = defaultdict(list)
    for position in sorted(right):
        for sense in right[position]:
            free[sense].append(position)
    used, pairs = set(), []
    for position in sorted(left, reverse=True):
        best = -1
        for sense in left[position]:
            waiting = free.get(sense, [])
            while waiting and waiting[-1] in used:
                waiting.pop()
            if waiting:
                best = max(best, waiting[-1])
        if best >= 0:
            used.add(best)
            pairs.append((position, best))
    return pairs


def align(prediction, reference, stems=True, prediction_senses=None, reference_senses=None):
    """(matches, chunks) of the exact, stem and synonym stages in that order."""
    left = dict(enumerate(prediction))
    right = dict(enumerate(reference))
    pairs = _pair(left, right)
    if stems:
        found = _pair({i: stem(w) for i, w in left.items()}, {i: stem(w) for i, w in right.items()})
        for a, b in found:
            del left[a]
            del right[b]
        pairs += found
    if prediction_senses is not None:
        pairs += _pair_senses(
            {i: prediction_senses[i] for i in left}, {i: reference_senses[i] for i in right}
        )
    pairs.sort()
    breaks = sum(c != a + 1 or d != b + 1 for (a, b), (c, d) in zip(pairs, pairs[1:]))
    return len(pairs), breaks + 1 if pairs else 0


def alignment(
    prediction: Column | str,
    reference: Column | str,
    stems: bool = True,
    senses: tuple[Column | str, Column | str] | None = None,
) -> Column:
    """struct(matches, chunks) of two arrays of lower-case tokens.

    ``senses`` gives, for both sides, an array of sense names per token.
    """

    @F.arrow_udf("matches int, chunks int")
    def count(*columns: pa.Array) -> pa.Array:
        def rows(*parts: list) -> list[dict]:
            found = [align(a, b, stems, *rest) for a, b, *rest in zip(*parts, strict=True)]
            return [{"matches": matches, "chunks": chunks} for matches, chunks in found]

        return by_slices(rows, pa.struct([("matches", pa.int32()), ("chunks", pa.int32())]), *columns)

    return count(prediction, reference, *(senses or ()))


def meteor_score(matches: Column, chunks: Column, predicted: Column, expected: Column) -> Column:
    """Score of one row from its counts; 0 without a match."""
    precision = matches / predicted
    recall = matches / expected
    mean = precision * recall / (ALPHA * precision + (1 - ALPHA) * recall)
    penalty = GAMMA * F.pow(chunks / matches, F.lit(BETA))
    return F.when(matches > 0, mean * (1 - penalty)).otherwise(F.lit(0.0))
