"""Long repeats of bytes and words against brute force."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from capstan.llm import anchors, debruijn, suffixes
from tests.llm.fixtures import awkward, table, texts_of


def covered(n, starts, length):
    marks = np.zeros(n, bool)
    for s in starts:
        marks[s : s + length] = True
    return marks


def bytes_left(rows, window):
    raws = [(i, t.encode()) for i, t in texts_of(rows)]
    seen = Counter(raw[s : s + window] for _, raw in raws for s in range(len(raw) - window + 1))
    out = []
    for i, raw in raws:
        gone = covered(len(raw), [s for s in range(len(raw) - window + 1) if seen[raw[s : s + window]] > 1], window)
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((i, len(raw), spans, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(out)


def words_left(rows, window):
    texts = [(i, t.encode().split()) for i, t in texts_of(rows)]
    first = {}
    for i, words in texts:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in texts:
        starts = [s for s in range(len(words) - window + 1) if first[tuple(words[s : s + window])] < i]
        gone = covered(len(words), starts, window)
        out.append((i, len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize("group", [suffixes.GROUP, 1])
def test_bytes(spark, group):
    rows = awkward()
    made = suffixes.without_repeats(table(spark, rows), group=group)
    got = sorted((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in made.collect())
    assert got == bytes_left(rows, 400)


def test_words(spark):
    rows = awkward()
    made = debruijn.without_repeats(table(spark, rows))
    got = sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in made.collect())
    assert got == words_left(rows, 50)


@pytest.mark.parametrize("seed", range(3))
def test_short_windows_over_few_letters(spark, seed):
    """Dense chance repeats, runs of one letter, overlaps inside a document, many contexts of one gram."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(25):
        text = "".join(rng.choice(list("ab "), rng.integers(0, 160)))
        rows.append((i, text + rows[rng.integers(0, i)][1][: rng.integers(0, 90)] if i else text))
    made = suffixes.without_repeats(table(spark, rows), window=16, gram=5, group=(20_000, 3, 1)[seed])
    assert sorted((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in made.collect()) == bytes_left(rows, 16)
    made = debruijn.without_repeats(table(spark, rows), window=5, gram=2)
    got = sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in made.collect())
    assert got == words_left(rows, 5)


def test_empty_tables(spark):
    assert suffixes.without_repeats(table(spark, [])).count() == 0
    assert debruijn.without_repeats(table(spark, [(None, "x")])).count() == 0


BYTES = st.lists(st.binary(max_size=40) | st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=30)


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@given(strings=BYTES)
@settings(max_examples=300, deadline=None)
def test_blind_trie(strings):
    order, common = suffixes.BlindTrie(strings, 0).order()
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
    assert common[1:] == [shared(strings[a], strings[b]) for a, b in zip(order, order[1:])]


@given(strings=BYTES, data=st.data())
@settings(max_examples=300, deadline=None)
def test_deep_shallow(strings, data):
    groups = np.array(data.draw(st.lists(st.integers(0, 2), min_size=len(strings), max_size=len(strings))))
    order, common = suffixes.deep_shallow(strings, groups, shallow=8)
    placed = [(groups[i], strings[i]) for i in order]
    assert [g for g, _ in placed] == sorted(groups)
    for n, (a, b) in enumerate(zip(placed, placed[1:]), 1):
        assert common[n] == (shared(a[1], b[1]) if a[0] == b[0] else -1)
        # Zero bytes and ends of strings may come in either order: runs of a prefix do not mind.
        assert a[0] < b[0] or a[1] <= b[1] or a[1].rstrip(b"\0") == b[1].rstrip(b"\0") or b"\0" in a[1] + b[1]


def test_long_sequences_have_the_same_anchors(monkeypatch):
    symbols = np.random.default_rng(3).integers(0, 3, 5000).astype(np.uint64) + np.uint64(1)
    whole = anchors.find(symbols, 40, 12)
    monkeypatch.setattr(anchors, "_AT_ONCE", 256)
    parts = anchors.find(symbols, 40, 12)
    for name in ("gram", "context", "place", "first", "last"):
        assert (getattr(whole, name) == getattr(parts, name)).all()
    assert whole.first[0] == 0 and whole.last[-1] == 5000 - 40 and (whole.first[1:] == whole.last[:-1] + 1).all()
