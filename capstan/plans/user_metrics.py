"""Metrics as a user would write them."""

from __future__ import annotations

import math
import re
from collections import Counter

from capstan.functions.text import WHITE_SPACE
from capstan.operators.bleu import SMOOTH_VALUE
from capstan.operators.ngrams import MAX_ORDER


class CorpusBleu:
    """Corpus BLEU over words: counts of matching and of all grams add up, the score comes last."""

    def zero(self) -> dict:
        return {"correct": Counter(), "total": Counter(), "predicted": 0, "expected": 0}

    def accumulate(self, state: dict, predictions: list[str], references: list[str]) -> dict:
        for prediction, reference in zip(predictions, references, strict=True):
            sides = [[w for w in re.split(WHITE_SPACE, t) if w] for t in (prediction, reference)]
            state["predicted"] += len(sides[0])
            state["expected"] += len(sides[1])
            for n in range(1, MAX_ORDER + 1):
                made, wanted = (Counter(tuple(s[i : i + n]) for i in range(len(s) - n + 1)) for s in sides)
                state["correct"][n] += (made & wanted).total()
                state["total"][n] += made.total()
        return state

    def merge(self, state: dict, other: dict) -> dict:
        return {key: state[key] + other[key] for key in state}

    def finish(self, state: dict) -> float:
        correct, total = ([state[k][n] for n in range(1, MAX_ORDER + 1)] for k in ("correct", "total"))
        if not any(correct) or not all(total):
            return 0.0
        logs = [math.log(100 * (c or SMOOTH_VALUE) / t) for c, t in zip(correct, total, strict=True)]
        short = min(0.0, 1 - state["expected"] / state["predicted"])
        return math.exp(short + sum(logs) / MAX_ORDER)
