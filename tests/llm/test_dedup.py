"""SimHash, fuzzy lines, connected groups and weighted samples against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from capstan.llm import lines, simhash, weighted
from capstan.llm.components import connected_components
from capstan.llm.workspace import Workspace
from tests.llm.fixtures import awkward, in_order, prose, table, texts_of


def groups_of(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(40)]
    frame = spark.createDataFrame([*links, (None, 3), (7, 7), *links[:5]], "a long, b long")
    roots = groups_of(200, links)
    wanted = {x: roots[x] for link in links for x in link if link[0] != link[1]}
    assert dict(in_order(connected_components(Workspace(spark), frame), "node", "component")) == wanted
    assert connected_components(Workspace(spark), frame.limit(0)).count() == 0


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    rows = awkward() + [(100 + i, prose(20, 400) + " " + prose(21 + i % 9, 1)) for i in range(30)]
    rows += [(200, "one"), (201, "One"), (202, "two words"), (203, "A b C"), (204, "a B c")]
    texts = texts_of(rows)
    prints = [fingerprint(t) for _, t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = groups_of(len(texts), links)
    least = {}
    for (i, _), r in zip(texts, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    made = simhash.near_duplicates(table(spark, rows))
    assert sorted((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in made.collect()) == sorted(
        (i, p, least[r]) for (i, _), p, r in zip(texts, prints, roots, strict=True)
    )
    kept = simhash.one_of_each(table(spark, rows))
    assert kept.columns == table(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))
    assert kept.where("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(table(spark, [])).count() == simhash.one_of_each(table(spark, [])).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_near_fingerprints(spark, distance):
    rng = np.random.default_rng(distance)
    seeds = rng.integers(-(1 << 63), (1 << 63) - 1, 20)
    values = {int(s) for s in seeds} | {0, -1, 1 << 62, -(1 << 63)}
    for s in seeds:
        for _ in range(15):
            flips = [1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)]
            values.add((int(s) ^ sum(flips) + (1 << 63)) % (1 << 64) - (1 << 63))
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    got = {frozenset((r.a, r.b)) for r in simhash.near_fingerprints(frame, distance).collect()}
    wanted = {
        frozenset((a, b)) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= distance
    }
    assert got == wanted


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_fingerprints(spark.createDataFrame([(1,)], "fingerprint long"), 4)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain(line):
    return " ".join(w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w)


def signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def lines_left(rows, every=False):
    """What is left of texts, and how many pairs of lines are linked: all alike, or those that SimHash finds near."""
    texts = texts_of(rows)
    spots = {}
    for i, t in texts:
        for n, line in enumerate(t.split("\n")):
            if plain(line):
                spots.setdefault(plain(line), set()).add((i, signed(t), n))
    kinds = list(spots)

    def bits(text):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.split(" ")]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [bits(k) for k in kinds]
    links = []
    kinds = [k.split(" ") for k in kinds]
    for i, a in enumerate(kinds):
        for j, b in enumerate(kinds[:i]):
            if every or (prints[i] ^ prints[j]).bit_count() <= lines.DISTANCE:
                longest = max(len(a), len(b))
                if edits(a, b) <= int(longest * 0.2 + 1e-9):
                    links.append((i, j))
    members = {}
    for k, r in zip(spots, groups_of(len(kinds), links), strict=True):
        members.setdefault(r, set()).update(spots[k])
    gone = {s for m in members.values() for s in m - {min(m)}}
    out = []
    for i, t in texts:
        parts = t.split("\n")
        kept = [p for n, p in enumerate(parts) if (i, signed(t), n) not in gone]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out), len(links)


def test_lines(spark):
    long = prose(40, 300).split()
    near = [" ".join([*long[:i], "changed", *long[i + 1 :]]) for i in range(12)]
    rows = [
        (1, "Alpha beta.\n\nalpha BETA!\n---\n---"),
        (2, None),
        (3, ""),
        (4, "\n".join(near[:4])),
        (5, near[5] + "\nsomething of its own\n" + near[6].upper()),
        (6, "something  of its own?"),
        (6, "Alpha beta"),
        (7, "same\nsame"),
        (7, "same\nsame"),
        (8, "\n".join(prose(50 + i, 3 + i) for i in range(40))),
        (None, "Alpha beta."),
    ]
    wanted, links = lines_left(rows)
    assert links
    made = lines.without_repeats(table(spark, rows))
    real = made.where("doc_id IS NOT NULL")
    assert sorted((r.doc_id, r.n_lines or (r.text is None), r.n_removed, r.text or "") for r in real.collect()) == wanted
    assert made.where("doc_id IS NULL").first().text == "Alpha beta."
    assert made.where("text IS NULL").count() == 1
    assert lines.without_repeats(table(spark, [])).count() == 0


@pytest.mark.parametrize("centres", [1, 8])
def test_many_near_copies_of_a_line(spark, monkeypatch, centres):
    """Chains of changes: groups hang together by lines that are far from one another."""
    monkeypatch.setattr(lines, "CENTRES", centres)
    rng = np.random.default_rng(4)
    rows = []
    for group in range(3):
        line = prose(60 + group, 250).split()
        for i in range(40):
            line = [w if rng.random() > 0.004 else prose(int(rng.integers(1, 10**6)), 1) for w in line]
            rows.append((group * 100 + i, " ".join(line) + "\n" + prose(900 + group * 100 + i, 5)))
    wanted, links = lines_left(rows)
    assert links > 200
    made = lines.without_repeats(table(spark, rows))
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in made.collect()) == wanted


@pytest.mark.parametrize(("centres", "band"), [(1, 1 << 24), (8, 40)])
def test_lines_of_any_length_with_few_edits(spark, monkeypatch, centres, band):
    """All pairs of enough edit similarity, however far their SimHashes are, in one range of sizes or several."""
    monkeypatch.setattr(lines, "CENTRES", centres)
    monkeypatch.setattr(lines, "BAND_WORDS", band)
    rng = np.random.default_rng(9)
    kinds = []
    for n in [*range(3, 31), 45, 60]:
        line = [f"w{x}" for x in rng.integers(0, 10**6, n)]
        kinds.append(line)
        for _ in range(3):
            new = list(line)
            for _ in range(int(rng.integers(1, max(1, n // 5) + 1))):
                at, kind = int(rng.integers(0, len(new))), int(rng.integers(0, 3))
                new[at : at + (kind != 1)] = [] if kind == 0 else [f"w{rng.integers(0, 10**6)}"]
            kinds.append(new)
    kinds = list(dict.fromkeys(map(tuple, kinds)))
    close = [(i, j) for i, a in enumerate(kinds) for j, b in enumerate(kinds[:i]) if edits(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)]
    roots = groups_of(len(kinds), close)
    made = lines.without_repeats(table(spark, [(i, " ".join(k)) for i, k in enumerate(kinds)]), every=True).collect()
    assert {r.doc_id for r in made if not r.n_removed} == set(roots)
    assert len(kinds) - len(set(roots)) > 70


def test_lines_that_share_a_passage_alone_are_not_paired(spark, monkeypatch):
    """Unlike lines around one passage, whose words differ by how often they stand there, and some like ones."""
    passage = " ".join(f"p{n}" for n in range(20))
    rows = [(i, f"{passage}" + f" own{i}" * 10) for i in range(60)]
    rows += [(100 + i, " ".join(f"q{i}x{j}" for j in range(5)) + f" {passage}" + f" own{i}" * 7) for i in range(6)]
    rows += [(200 + i, f"{passage}" + f" own{i}" * 11) for i in range(50, 54)]
    taken, alike = {}, lines._alike

    def counted(work, pairs, kinds, name):
        taken[name] = pairs.count()
        return alike(work, pairs, kinds, name)

    monkeypatch.setattr(lines, "_alike", counted)
    made = lines.without_repeats(table(spark, rows), every=True)
    wanted, links = lines_left(rows, every=True)
    assert links >= 4
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in made.collect()) == wanted
    # By sets of different words any two of the first sixty may be alike: 1,326 pairs beyond those with eight of them.
    assert taken["others-0"] < 100


def test_wide_sets_tell_words_and_repeats_without_a_row_a_word(spark):
    rng = random.Random(8)
    texts = ["a", "a a a b", "b a", *[" ".join(rng.choices("abcdefg", k=rng.randint(1, 30))) for _ in range(40)]]
    kinds = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, plain string")
    made = lines.wide_sets(kinds)
    # The rows of a line's words grew faster than the lines: there are none.
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    sets = {r.key: [r[c] for c in lines.WIDE_BITS] for r in made.collect()}
    assert len(sets) == len(texts)
    words = [Counter(t.split()) for t in texts]

    def lacking(x, y):
        return sum(((v & ~w) & (1 << 64) - 1).bit_count() for v, w in zip(sets[x], sets[y]))

    for x, y in itertools.product(range(len(texts)), repeat=2):
        wanted = (words[x] - words[y]).total()
        # Members may fall together on a bit, so a pair may seem closer, never further.
        assert lacking(x, y) <= wanted
        assert x > 2 or y > 2 or lacking(x, y) == wanted


def test_sets_of_words_lie_beside_places_where_lines_are_compared_by_them_alone(spark, monkeypatch):
    """Places of the SimHash are tens of bytes a row; groups come to places when these are made, not by moving them again."""
    rows = [(i, " ".join(f"l{i // 3}x{j}" for j in range(12)) + f" own{i}") for i in range(60)]
    stored, apart, store, pairs_apart = {}, [], Workspace.store, lines.pairs_apart

    def noted(work, df, name):
        stored[name] = df.columns
        return store(work, df, name)

    def planned(*sides):
        made = pairs_apart(*sides)
        apart.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(Workspace, "store", noted)
    monkeypatch.setattr(lines, "pairs_apart", planned)
    made = lines.without_repeats(table(spark, rows), every=True)
    wanted, links = lines_left(rows, every=True)
    assert links == 60
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in made.collect()) == wanted
    assert stored["near"] == ["place", "key", "simhash", "size"]
    assert "group" in stored["places"]
    # Two sides of a join by place, the centres of one side, different pairs: none by key.
    assert apart and all(not re.search(r"hashpartitioning\(key#", plan) for plan in apart)


def test_plain_lines(spark):
    texts = ["Alpha beta.\n\nalpha--BETA!\n---", "\n", "", " a\tb \r\n c\x0bd\n", "ΟΔΟΣ\nΟΔΟΣ, ΣΑΣ\nΣ", "é😀x 𝔄𝔅\n½ ٣x\n_a_", "n\\n x\u2028y\u0085z"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r.id: r.found for r in frame.select("id", lines.plain_lines(F.col("text")).alias("found")).collect()}
    assert got == {i: [plain(line) for line in t.split("\n")] for i, t in enumerate(texts)}


@pytest.mark.parametrize(("every", "symbols"), [(False, 1_000_000), (True, 1_000_000), (True, 3)])
def test_words_that_are_not_the_same_are_never_taken_for_it(spark, monkeypatch, every, symbols):
    """Lines with three of ten words changed, among them words that fell together in letters of a fixed number."""
    monkeypatch.setattr(lines, "_by_hash", lambda w: F.pmod(F.xxhash64(w), F.lit(symbols)))
    start = " ".join(f"b{n}" for n in range(7))
    rows = [(1, f"{start} zz156 zz232 zz65"), (2, f"{start} zz447 zz501 zz509"), (3, f"{start} zz156 zz232 zz66")]
    made = {r.doc_id: r.n_removed for r in lines.without_repeats(table(spark, rows), every=every).collect()}
    assert made[2] == 0 and (made[3] == 1 or not every)
    wanted, _ = lines_left(rows, every)
    assert [(i, n) for i, _, n, _ in wanted] == sorted(made.items())


def test_every_line_is_compared_in_awkward_tables(spark):
    rows = [(1, "a b c d e f g\n\n--\na b c d e f g"), (2, None), (3, ""), (4, "a b c d e f x"), (5, " \n\t"), (6, "A, b c D e f g!")]
    rows += [(6, "tail"), (7, "same\nsame"), (7, "same\nsame"), (8, "w " * 4000 + "v"), (9, "w " * 3999 + "u v"), (None, "a b c d e f g")]
    rows += [(20 + i, " ".join(f"n{i}x{j}" for j in range(3 + 7 * i)) + ("\n" + " ".join(f"n{i}x{j}" for j in range(1, 3 + 7 * i)))) for i in range(9)]
    made = lines.without_repeats(table(spark, rows), every=True)
    wanted, links = lines_left(rows, every=True)
    real = made.where("doc_id IS NOT NULL")
    assert links > 8
    assert sorted((r.doc_id, r.n_lines or (r.text is None), r.n_removed, r.text or "") for r in real.collect()) == wanted
    assert made.where("doc_id IS NULL").first().text == "a b c d e f g" and made.where("text IS NULL").count() == 1
    assert lines.without_repeats(table(spark, []), every=True).count() == 0


@pytest.mark.parametrize("words", [1, 126, 127, 128, 255, 1000])
def test_majority_of_many_words(spark, words):
    text = prose(words, words)
    rows = lines.line_rows(spark.createDataFrame([(1, 2, text)], "doc_id long, mark long, text string"))
    row = lines.simhashes(lines.different_lines(rows)).first()
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.split()]
    assert row.simhash % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > words)


def generalised_jaccard(a, b):
    a, b = Counter(re.findall(r"[^\x20\x09-\x0D]+", a)), Counter(re.findall(r"[^\x20\x09-\x0D]+", b))
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_weighted_samples(spark):
    rows = [(i * 37, prose(i, 200) + " common" * (i % 5)) for i in range(60)]
    rows += [(5000 + i, t) for i, (_, t) in enumerate([*rows[:3], (0, None), (0, ""), (0, "  "), (0, "é😀x")])]
    rows += [(5001, rows[1][1]), (5001, "other row of that id"), (None, "no id")]
    texts = sorted(texts_of(rows), key=lambda r: (r[0], signed(r[1])))
    wanted = []
    for n, (i, text) in enumerate(texts):
        following = texts[(n + 1) % len(texts)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        wanted.append((i, len(text), edited, generalised_jaccard(text, edited), generalised_jaccard(text, following)))
    got = weighted.edited_fingerprints(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited) for r in got) == sorted(w[:3] for w in wanted)
    true = sorted((w[0], w[1], w[2], w[3], w[4]) for w in wanted)
    made = sorted((r.doc_id, r.n_chars, r.edited, r.near_edited, r.near_next) for r in got)
    for k in (3, 4):
        off = np.array([t[k] - m[k] for t, m in zip(true, made, strict=True)])
        assert abs(off.mean()) < 0.05 and np.sqrt((off**2).mean()) < 0.12
    assert weighted.edited_fingerprints(table(spark, [])).count() == 0
    # A document alone is its own next one.
    alone = weighted.edited_fingerprints(table(spark, [(1, "only one")])).first()
    assert (alone.edited, alone.near_next) == ("only oon", 1.0)


@pytest.mark.parametrize("times", [1, 100, 1000])
def test_heavy_words_weigh_in_every_sample(spark, times):
    # Two documents share a heavy word: samples of different words are independent.
    rows = [(i, f"heavy{i // 2} " * times + " ".join(f"d{i}w{n}" for n in range(200))) for i in range(60)]
    made = weighted.edited_fingerprints(table(spark, rows)).collect()
    texts = dict(rows)
    off = [r.near_next - generalised_jaccard(texts[r.doc_id], texts[(r.doc_id + 1) % 60]) for r in made]
    off += [r.near_edited - generalised_jaccard(texts[r.doc_id], r.edited) for r in made]
    assert abs(np.mean(off)) < 0.03 and np.sqrt(np.mean(np.square(off))) < 0.09


def test_equal_texts_have_equal_samples(spark):
    rows = [(1, "a b b c"), (2, "c b a b"), (3, "a b c"), (4, None), (5, "")]
    made = {r.doc_id: r.entries for r in weighted.fingerprints(table(spark, rows)).collect()}
    assert made[1] == made[2] and made[1] != made[3] and made[4] == made[5] == []


def test_collision_rate_is_the_similarity(spark):
    """Many pairs of known similarity, weights differing: the mean likeness comes near it."""
    rng = np.random.default_rng(9)
    rows, true = [], []
    for i in range(60):
        weights = rng.integers(1, 4, (2, 300))
        weights[1, : 150 + i] = weights[0, : 150 + i]
        words = [f"w{i}x{n}" for n in range(300)]
        a, b = (" ".join(w for w, n in zip(words, row, strict=True) for _ in range(n)) for row in weights)
        rows += [(2 * i, a), (2 * i + 1, b)]
        true.append(generalised_jaccard(a, b))
    made = weighted.fingerprints(table(spark, rows)).withColumn("pair", F.expr("doc_id div 2"))
    both = made.groupBy("pair").agg(F.collect_list("entries").alias("e"))
    likeness = weighted.likeness(F.col("e")[0], F.col("e")[1])
    got = [r[0] for r in both.orderBy("pair").select(likeness).collect()]
    assert abs(np.mean(got) - np.mean(true)) < 0.03
