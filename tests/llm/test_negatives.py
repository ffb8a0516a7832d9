"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, key string, place int, leaf int, ids string"
REST = (1, "x", 2, 3, "y")


def expected(rows, positives=5, count=3):
    """Every score of every anchor; rows are (id, vector, label), ids being different."""
    ids = np.array([r[0] for r in rows], np.int64)
    labels = [r[2] for r in rows]
    whole = [[int(np.floor(np.float64(256) * x)) for x in r[1]] for r in rows]
    out = []
    for a in np.nonzero(ids % 50 == 0)[0]:
        score = [sum(x * y for x, y in zip(v, whole[a], strict=True)) for v in whole]
        order = sorted(range(len(rows)), key=lambda i: (-score[i], ids[i]))
        own = [i for i in order if labels[i] == labels[a] and i != a][:positives]
        for p in own:
            fits = [i for i in order if labels[i] != labels[a] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(ids[a], ids[p], k + 1, ids[i], score[p], score[i]) for k, i in enumerate(fits[:count])]
    return sorted(tuple(int(x) for x in r) for r in out)


def found(spark, rows, **kwargs):
    frame = spark.createDataFrame([(*r, *REST) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, **kwargs).collect()))


def vectors(n, d, seed, grid=None):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, d)) + 2 * rng.normal(size=(12, d))[rng.integers(0, 12, n)]
    made = np.round(made * grid) / grid if grid else made
    return [(int(i), [float(x) for x in v], int(rng.integers(0, 4))) for i, v in zip(rng.permutation(n) * 5, made, strict=True)]


@pytest.mark.parametrize("d", [2, 16])
def test_all_and_only_the_hard_ones(spark, monkeypatch, d):
    monkeypatch.setattr(negatives, "LEAF_SAMPLE", 20)
    monkeypatch.setattr(negatives, "SAMPLE", 400)
    rows = vectors(1500, d, d)
    got = found(spark, rows)
    assert got and got == expected(rows)


def test_ties_copies_and_blocks(spark, monkeypatch):
    rows = vectors(600, 3, 5, grid=1)
    # One vector holds a third of the rows, under two labels.
    rows = [(i, rows[0][1] if i % 3 == 0 else v, i % 2 if i % 3 == 0 else k) for i, v, k in rows]
    want = expected(rows)
    assert want and found(spark, rows) == want
    monkeypatch.setattr(negatives, "BLOCK", 7)
    monkeypatch.setattr(negatives, "QUERY_BLOCK", 3)
    monkeypatch.setattr(negatives, "LEAF_SAMPLE", 10)
    assert found(spark, rows) == want


def test_rows_that_take_no_part(spark):
    rows = vectors(120, 4, 9)
    want = expected(rows)
    bad = [(None, rows[0][1], 1), (10_000, None, 1), (10_050, rows[1][1], None), (10_100, [1.0], 1), (10_150, [], 1)]
    bad += [(20_000, [float("nan"), 1.0, 1.0, 1.0], 1), (20_050, [None, 1.0, 1.0, 1.0], 1)]
    bad += [(20_100, [float("-inf"), 1.0, 1.0, 1.0], 1), (20_150, [1e300, 1.0, 1.0, 1.0], 1)]
    assert found(spark, rows + bad + rows[:7]) == want


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(spark, n):
    rows = [(50 * i, [1.0, 0.6 + 0.1 * i], i // 2) for i in range(n)]
    assert found(spark, rows) == expected(rows)


def test_zero_and_long_vectors_are_exact(spark):
    rows = [(0, [0.0, 0.0], 0), (1, [0.0, 0.0], 0), (2, [0.0, 0.0], 1), (50, [4e6, 4.1e6], 2), (51, [3e6, 3.7e6 + 0.5], 2)]
    rows += [(60 + i, [2e6 + i / 256, 2.5e6], 1) for i in range(9)]
    got = found(spark, rows)
    assert got == expected(rows) and max(r[4] for r in got) > 2**53 and (0, 1, 1, 2, 0, 0) in got


def test_other_numbers_of_rows(spark):
    rows = vectors(200, 4, 2)
    assert found(spark, rows, positives=2, negatives=8) == expected(rows, 2, 8)


def test_ranges_leave_leaves_out(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF_SAMPLE", 20)
    made = np.array([r[1] for r in vectors(2000, 3, 1)]) * 100
    tree = negatives.Tree(made, float(np.sqrt((made**2).sum(axis=1).max())) * (1 + 1e-12))
    leaf = tree.assign(made)
    for at, _, far, nearest in tree.descend(made):
        for child in np.unique(nearest).tolist() if far is not None else []:
            tree.nodes[at].low[:, child] = far[nearest == child].min(axis=0)
            tree.nodes[at].high[:, child] = far[nearest == child].max(axis=0)
    scores = np.sort(made[:50] @ made.T, axis=1)
    low, high = scores[:, [-60, 5]], scores[:, [-50, 4]]
    rows, leaves = tree.leaves_of(made[:50], low, high)
    for i, anchor in enumerate(made[:50]):
        inside = (made @ anchor >= low[i, 0]) & (made @ anchor <= high[i, 0])
        assert set(leaf[inside]) <= set(leaves[rows == i])
    assert tree.leaves > 50 and len(leaves) < 50 * tree.leaves / 2
