"""Beam search against a plain search over the whole model."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from capstan.operators import generation as G
from capstan.session import bucketed, checkpoint_root, stored

CORPUS = {
    1: ["a b a b c", "a b c d", "b b a", "c"],
    2: ["x y x y x", "x y"],
    3: ["the dog runs", "the dog sleeps", "a dog runs fast", "the cat sleeps"],
    # Always the same loop: the second round may not repeat a bigram.
    4: ["p q p q p q p q"],
}


def plain_search(texts, beams, steps, size=2, start=()):
    counts = defaultdict(Counter)
    for text in texts:
        seq = [G.START, *text.split(), G.END]
        for a, b in zip(seq, seq[1:]):
            counts[a][b] += 1
    live, done, ends = [([G.START, *start], 0)], [], 0
    for _ in range(steps):
        formed, stuck = [], []
        for seq, logp in live:
            used = {tuple(seq[i : i + size]) for i in range(len(seq) - size + 1)} if size else set()
            total = sum(counts[seq[-1]].values())
            tail = seq[len(seq) - size + 1 :] if size else []
            allowed = [b for b in counts[seq[-1]] if (*tail, b) not in used]
            if not allowed:
                stuck.append((seq, logp))
            for b in allowed:
                step = math.floor(math.log(counts[seq[-1]][b] / total) * 1e6 + 0.5)
                formed.append((-(logp + step), seq + [b]))
        done += [(-(logp / 1e6 / len(seq)), seq) for seq, logp in stuck]
        live = []
        for rank, (cost, seq) in enumerate(sorted(formed)[: 2 * beams]):
            if seq[-1] == G.END:
                if rank < beams:
                    ends += 1
                    done.append((cost / 1e6 / (len(seq) - 1), seq))
            elif len(live) < beams:
                live.append((seq, -cost))
        if ends >= beams:
            live = []
            break
    done += [(-(logp / 1e6 / len(seq)), seq) for seq, logp in live]
    return min(done)


def captions(spark):
    rows = [(i, 10 * i + k, t) for i, texts in CORPUS.items() for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "image_id long, caption_id long, caption string")
    return df.withColumn("seq", G.marked(F.split("caption", " ")))


@pytest.mark.parametrize("beams,steps", [(1, 4), (2, 6), (5, 16), (5, 1)])
def test_search(spark, beams, steps):
    by = ["image_id"]
    df = captions(spark)
    table = G.next_tokens(G.bigrams(df, by, "seq"), by)
    starts = df.select("image_id").distinct().withColumn("seq", F.array(F.lit(G.START)))
    found = {r["image_id"]: r for r in G.beam_search(table, starts, by, beams, steps).collect()}
    assert set(found) == set(CORPUS)
    for key, texts in CORPUS.items():
        cost, seq = plain_search(texts, beams, steps)
        assert found[key]["seq"] == seq
        assert found[key]["score"] == pytest.approx(-cost)


def test_corpus_wide_model(spark):
    df = captions(spark)
    table = G.next_tokens(G.bigrams(df, [], "seq"), [])
    rows = {(r["prev"], r["next"]): r for r in table.collect()}
    # "a" is followed by b three times, by the end once and by dog once.
    assert rows["a", "b"]["rank"] == 1
    assert rows["a", "b"]["logp"] == round(math.log(3 / 5) * 1e6)
    scores = G.token_scores(G.bigrams(df, [], "seq"), [])
    assert {(r["prev"], r["next"]): r["logp"] for r in scores.collect()} == {k: r["logp"] for k, r in rows.items()}


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4])
def test_grams_that_may_not_repeat(spark, size):
    by = ["image_id"]
    df = captions(spark)
    table = G.next_tokens(G.bigrams(df, by, "seq"), by)
    starts = df.select("image_id").distinct().withColumn("seq", F.array(F.lit(G.START)))
    found = {r["image_id"]: r for r in G.beam_search(table, starts, by, 3, 9, no_repeat_size=size).collect()}
    for key, texts in CORPUS.items():
        assert found[key]["seq"] == plain_search(texts, 3, 9, size)[1]


def test_one_table_for_all_prompts(spark):
    df = captions(spark)
    table = G.next_tokens(G.bigrams(df, [], "seq"), [])
    prompts = [(1, ["a"]), (2, ["the", "dog"]), (3, ["unknown"]), (4, []), (5, ["a"])]
    starts = spark.createDataFrame([(i, [G.START, *p]) for i, p in prompts], "id long, seq array<string>")
    found = {r["id"]: r for r in G.beam_search(table, starts, ["id"], 4, 5, 3, table_by=[]).collect()}
    every = [t for texts in CORPUS.values() for t in texts]
    for key, prompt in prompts:
        cost, seq = plain_search(every, 4, 5, start=prompt)
        assert found[key]["seq"] == seq and found[key]["score"] == pytest.approx(-cost)


def test_whole_and_cut_tables_agree(spark):
    df = captions(spark)
    for by in ([], ["image_id"]):
        counts = G.bigrams(df, by, "seq")
        whole = G.next_tokens(counts, by)
        assert whole.count() == counts.count()
        first = sorted(tuple(r) for r in whole.where("rank <= 2").collect())
        assert sorted(tuple(r) for r in G.next_tokens(counts, by, 2).collect()) == first
    counts = spark.createDataFrame([("p", "b", 10_000_000), ("p", "a", 9_999_999), ("p", "c", 1)], "prev string, next string, n long")
    ranks = {r["next"]: r["rank"] for r in G.next_tokens(counts, []).collect()}
    # The first two have one rounded score: ties go by token, as in the search.
    assert ranks == {"a": 1, "b": 2, "c": 3}


@pytest.mark.parametrize("rows,count", [(0, 0), (3, 4), (2, 1 << 40), (1 << 40, 2), (1 << 40, 1 << 40)])
def test_common_tokens_alone_are_ranked_by_range(spark, monkeypatch, rows, count):
    pairs = [(f"t{i % 7}", f"s{i}", 1 + i * i % 5) for i in range(40)] + [("t0", None, 2), (None, "x", 3)]
    counts = spark.createDataFrame(pairs, "prev string, next string, n long")
    ranged, by_range = [], G._ranked_by_range
    note = lambda counts: ranged.extend(r.prev for r in counts.select("prev").distinct().collect()) or by_range(counts)
    monkeypatch.setattr(G, "_ranked_by_range", note)
    monkeypatch.setattr(G, "GROUP_ROWS", rows)
    monkeypatch.setattr(G, "APART_COUNT", count)
    found = {(r.prev, r.next): (r["rank"], r.logp) for r in G.next_tokens(counts, []).collect()}
    wanted, common = {}, set()
    for token in {p for p, _, _ in pairs if p}:
        own = [(n, s) for p, s, n in pairs if p == token]
        total = sum(n for n, _ in own)
        if len(own) > rows or max(own)[0] > count:
            common.add(token)
        for place, (n, s) in enumerate(sorted(own, key=lambda e: (-e[0], e[1] is not None, e[1] or "")), 1):
            wanted[token, s] = (place, math.floor(math.log(n / total) * 1e6 + 0.5))
    assert found == wanted and set(ranged) - {None} == common


def test_a_search_leaves_no_files(spark):
    import pathlib

    by = ["image_id"]
    df = captions(spark)
    table = stored(G.next_tokens(G.bigrams(df, by, "seq"), by), "model")
    starts = df.select("image_id").distinct().withColumn("seq", F.array(F.lit(G.START)))
    folder = pathlib.Path(checkpoint_root(spark).removeprefix("file:")) / "scratch"
    before = {p.name for p in folder.iterdir()}
    G.beam_search(table, starts, by, 2, 4)
    assert {p.name.split("-")[0] for p in folder.iterdir() if p.name not in before} == {"hypotheses"}


def test_a_search_by_key_moves_nothing_between_steps(spark, monkeypatch):
    """One written table, however many steps; large tables and repeated starts go step by step, alike."""
    from capstan.session import Scratch

    by, steps = ["image_id"], []
    df = captions(spark)
    table = stored(G.next_tokens(G.bigrams(df, by, "seq"), by), "model")
    keys = [(k,) for k in (*CORPUS, 9, None)]
    starts = spark.createDataFrame(keys, "image_id long").withColumn("seq", F.array(F.lit(G.START)))
    store = Scratch.store
    monkeypatch.setattr(Scratch, "store", lambda self, df, name: steps.append(name) or store(self, df, name))
    whole = {r["image_id"]: tuple(r) for r in G.beam_search(table, starts, by, 3, 9).collect()}
    assert not steps and set(whole) == {*CORPUS, 9, None}
    for key, texts in CORPUS.items():
        assert whole[key][1] == plain_search(texts, 3, 9)[1]
    assert whole[9][1] == whole[None][1] == [G.START]
    # Pictures of more than ten entries: 1 and 3.
    for entries in (0, 10):
        monkeypatch.setattr(G, "ROW_ENTRIES", entries)
        steps.clear()
        assert {r["image_id"]: tuple(r) for r in G.beam_search(table, starts, by, 3, 9).collect()} == whole
        assert steps
    monkeypatch.undo()
    found = G.beam_search(table, starts.unionByName(starts.where("image_id = 2 OR image_id IS NULL")), by, 3, 9).collect()
    assert {r["image_id"]: r["seq"] for r in found} == {k: v[1] for k, v in whole.items()} and len(found) == len(whole)


def test_text(spark):
    df = spark.createDataFrame([([G.START, "a", "b", G.END],)], "s array<string>")
    assert df.select(G.generated_text("s")).first()[0] == "a b"


def test_a_step_leaves_the_lists_in_place(spark):
    by = ["image_id"]
    df = captions(spark)
    lists = G.successor_lists(G.next_tokens(G.bigrams(df, by, "seq"), by), by)
    live = df.select("image_id", F.array(F.lit(G.START)).alias("seq"), F.lit(0).cast("long").alias("logp"))
    live = stored(live.withColumn("ends", F.lit(0).cast("long")), "live")
    with bucketed(lists, "lists", 100, "image_id", "prev") as written:
        plan = G.beam_step(live, written, by, 5)._jdf.queryExecution().executedPlan().toString()
        name = written.inputFiles()[0]
    join = plan[plan.index("SortMergeJoin") :]
    assert "LeftOuter" in join.splitlines()[0] and "Hash" not in join.splitlines()[0]
    # One exchange below the join: the live beams.
    assert join.count("Exchange") == 1 and "Bucketed: true" in join
    assert "lists-" in name and not [t for t in spark.catalog.listTables() if t.name.startswith("lists")]
