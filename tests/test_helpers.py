"""Row helpers against brute force."""

import os
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from capstan.functions.alignment import align
from capstan.functions.pixels import model_pixels, resize_weights, to_rgb
from capstan.functions.stemming import stem
from capstan.functions.subsequence import lcs_length, lcs_positions, summary_hits

tokens = st.lists(st.sampled_from("abcd"), max_size=14)
lines = st.lists(st.lists(st.sampled_from("abcd"), max_size=6), max_size=4)


def lcs_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table


@given(tokens, tokens)
def test_lcs_length(a, b):
    assert lcs_length(a, b) == lcs_table(a, b)[-1][-1]
    assert lcs_length(a, b) == lcs_length(b, a) <= min(len(a), len(b))


@given(tokens, tokens)
def test_lcs_positions(a, b):
    table = lcs_table(a, b)
    i, j, expected = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            expected.insert(0, i - 1)
            i, j = i - 1, j - 1
        elif table[i][j - 1] > table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    assert lcs_positions(a, b) == expected


@given(lines, lines)
def test_summary_hits(reference, candidate):
    left_r, left_c = Counter(sum(reference, [])), Counter(sum(candidate, []))
    hits = 0
    for line in reference:
        union = sorted({p for other in candidate for p in lcs_positions(line, other)})
        for p in union:
            if left_r[line[p]] > 0 and left_c[line[p]] > 0:
                hits += 1
                left_r[line[p]] -= 1
                left_c[line[p]] -= 1
    assert summary_hits(reference, candidate) == hits


def greedy_pairs(left, right, same):
    """Last with last, both lists scanned from the end."""
    pairs = []
    for i in sorted(left, reverse=True):
        for j in sorted(right, reverse=True):
            if same(left[i], right[j]):
                pairs.append((i, j))
                del left[i], right[j]
                break
    return pairs


words = st.lists(st.sampled_from(["run", "runs", "running", "cat", "cats", "the"]), max_size=9)
SENSES = {"run": ["move"], "cat": ["pet", "whip"], "the": [], "runs": ["move", "pet"], "cats": [], "running": []}


@given(words, words)
def test_alignment(prediction, reference):
    left, right = dict(enumerate(prediction)), dict(enumerate(reference))
    pairs = greedy_pairs(left, right, lambda a, b: a == b)
    pairs += greedy_pairs(left, right, lambda a, b: stem(a) == stem(b))
    without = sorted(pairs)
    pairs += greedy_pairs(left, right, lambda a, b: bool(set(SENSES[a]) & set(SENSES[b])))

    def chunks(rows):
        return sum(k == 0 or rows[k - 1] != (a - 1, b - 1) for k, (a, b) in enumerate(rows))

    assert align(prediction, reference) == (len(without), chunks(without))
    senses = [[SENSES[w] for w in side] for side in (prediction, reference)]
    assert align(prediction, reference, True, *senses) == (len(pairs), chunks(sorted(pairs)))


def test_stems():
    # Examples of the published rules.
    expected = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
        "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
        "conflated": "conflat", "sized": "size", "hopping": "hop", "falling": "fall", "filing": "file",
        "happy": "happi", "relational": "relat", "rational": "ration", "digitizer": "digit",
        "radically": "radic", "vietnamization": "vietnam", "hopefulness": "hope", "formality": "formal",
        "triplicate": "triplic", "electrical": "electr", "goodness": "good", "revival": "reviv",
        "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "effective": "effect",
        "probate": "probat", "rate": "rate", "cease": "ceas", "controlling": "control", "roll": "roll",
        "skies": "sky", "dying": "die", "is": "is", "sky": "sky", "enjoy": "enjoy", "died": "die",
    }
    assert {word: stem(word) for word in expected} == expected


def test_channels():
    grey = to_rgb(bytes([7, 9]), 1, 2, 1)
    assert grey.tolist() == [[[7, 7, 7], [9, 9, 9]]]
    assert to_rgb(bytes([1, 2, 3]), 1, 1, 3).tolist() == [[[3, 2, 1]]]
    assert to_rgb(bytes([1, 2, 3, 200]), 1, 1, 4).tolist() == [[[3, 2, 1]]]


@settings(deadline=None)
@given(st.integers(1, 300))
def test_weights(size):
    weights = resize_weights(size)
    assert weights.shape == (224, size)
    assert np.abs(weights.sum(axis=1) - (1 << 22)).max() <= size
    flat = np.full((size, 3, 3), 200, dtype=np.uint8)
    values = model_pixels(flat)
    assert np.allclose(values, (200 / 255 - 0.5) / 0.5, atol=0.01)


def test_shrink_averages():
    # Halving 448 to 224: weights 1/8, 3/8, 3/8, 1/8 around each output pixel.
    row = resize_weights(448)[100]
    assert np.round(row[199:203] / (1 << 22), 3).tolist() == [0.125, 0.375, 0.375, 0.125]


def test_stored_tables_go_at_the_end_of_a_job(spark, monkeypatch):
    from capstan import session

    monkeypatch.setattr(session, "_STORED", {})
    kept = session.stored(spark.range(3), "kept")
    path = kept.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert kept.count() == 3 and os.path.isdir(path)
    assert session.clear_stored(spark) == 1 and not os.path.exists(path) and session.clear_stored(spark) == 0
