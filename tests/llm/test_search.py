"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def rows_of(n=900, d=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, d)) * 2
    vectors = (centres[rng.integers(0, 30, n)] + rng.normal(size=(n, d))).astype(np.float32)
    vectors[50:300] = vectors[50]
    rows = [(i, [float(x) for x in v], i, "x") for i, v in enumerate(vectors)]
    rows += [(10_000, None, 1, ""), (10_020, [0.0] * d, 1, ""), (10_040, [float("nan")] + [1.0] * (d - 1), 1, "")]
    rows += [(10_060, [None] + [1.0] * (d - 1), 1, ""), (10_080, [1.0], 1, ""), (None, rows[0][1], 1, ""), rows[5], rows[20]]
    rows.append((10_100, [float("inf")] + [1.0] * (d - 1), 1, ""))
    return rows, vectors.astype(np.float64)


def exact(vectors, query, k):
    scores = vectors @ vectors[query]
    order = np.lexsort((np.arange(len(vectors)), -scores))
    return [int(i) for i in order if i != query][:k]


def test_search(spark):
    rows, vectors = rows_of()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == list(range(0, 900, 20))
    hits = 0
    for query, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        ids = [r.vec_id for r in found]
        assert query not in ids and len(set(ids)) == 20
        assert np.allclose([r.score for r in found], vectors[ids] @ vectors[query], rtol=1e-13, atol=1e-12)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        hits += len(set(ids) & set(exact(vectors, query, 20)))
    assert hits >= 0.95 * 20 * len(got)
    # All rows of the hot vector tie: the smaller ids come first.
    hot = next(q for q in got if 50 <= q < 300)
    top = [r.vec_id for r in got[hot] if r.score == got[hot][0].score]
    if vectors[hot] @ vectors[hot] == got[hot][0].score:
        assert top == [i for i in range(50, 300) if i != hot][:20]


def test_blocks_of_a_leaf_give_the_same(spark, monkeypatch):
    rows, _ = rows_of(seed=3)
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, k=5).collect()
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    parts = ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, k=5).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts))


@pytest.mark.parametrize("n", [0, 1, 4])
def test_few_rows(spark, n):
    rows = [(20 * i, [1.0, float(i)], 0, "") for i in range(n)]
    got = ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=20).collect()
    assert len(got) == n * max(0, n - 1)


def test_walk_visits_every_leaf_once():
    _, vectors = rows_of()
    tree = ann.Tree(vectors)
    assert sorted(tree.walk(vectors[3])) == list(range(tree.leaves)) and tree.leaves > 4
    assert set(tree.assign(vectors)) == set(range(tree.leaves))


def test_ties_go_to_the_smaller_id_whatever_the_blocks():
    rng = np.random.default_rng(6)
    points = rng.integers(0, 2, (400, 10)).astype(float)
    ids = rng.permutation(400) * 3
    queries = points[:50]
    rows, found, scores = ann.best(queries, points, ids, 7)
    for q in range(50):
        exact_scores = points @ queries[q]
        order = np.lexsort((ids, -exact_scores))[:7]
        assert found[rows == q].tolist() == ids[order].tolist() and scores[rows == q].tolist() == exact_scores[order].tolist()
    assert len(ann.best(queries, points[:3], ids[:3], 7)[0]) == 150
