"""Personal data against the plain patterns, and telling terms against counts by hand."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from capstan.llm import pii
from tests.llm.fixtures import table, texts_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if holds(k, m.group())]


HARD = [
    None, "", "no data", "a@b.c.@d.e x@y", "a@b.c_d@e.f.g", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111x4111  1111111111111111 4111 1111 1111 1112", "4111111111111111 5500 0000",
    "+1 (555) 123-4567.) +49 30 1234567 ++12345678 +1", "😀😀 a.b@c.de é +12 345 678 90 ü 10.0.0.1",
    "\u0001 4111\u00011111 4111 1111 1111 1111\u0001 a@b.cd", "x" * 20000 + "@", "1 " * 5000, "a.b@c.d " * 300,
    "9" * 4000 + ".1.1.1", "+1 " + "(" * 5000, "mail:me+you@x-y.co.uk,you@z.org;", "+4917012345678 4111-1111 1111-1111",
]


def test_base_spans(spark):
    rows = [*enumerate(HARD), (100, HARD[6]), (100, HARD[8]), (None, "a@b.cd")]
    got = sorted((r.doc_id, [(b.kind, b.start, b.end) for b in r.base]) for r in pii.find(table(spark, rows)).collect())
    assert got == sorted((i, spans(t)) for i, t in texts_of(rows))
    assert pii.find(table(spark, [])).count() == 0


def corpus():
    rows = []
    for i in range(40):
        rows.append((i, f"filler {i} lorem ipsum dolor sit amet words of common prose number{i} and more " * 3))
    for i in range(4):
        rows.append((100 + i, f"note{i} from Zephyrine Quill write to z.quill@example.org about item{i} soon and more"))
    # A copy is no evidence: this word stands in one surrounding alone.
    rows += [(200 + i, "the lonelyword beside +44 20 7946 0958 of prose") for i in range(3)]
    return rows


def by_hand(rows):
    """Terms that give enough away, from the counts themselves."""
    beside, words = defaultdict(list), Counter()
    for i, t in rows:
        words.update(w.lower() for w in re.findall(r"[^\W\d_][^\W_]*", re.sub(PATTERNS["email"], " ", t)))
        base = spans(t)
        for kind, s, e in base:
            left, right = max(0, s - pii.REACH), min(len(t), e + pii.REACH)
            name = kind + ":" + t[s:e].lower()
            for m in re.finditer(r"[^\W\d_][^\W_]*", t):
                inside = left <= m.start() and m.end() <= s or e <= m.start() and m.end() <= right
                cut = left > 0 and m.start() == left or right < len(t) and m.end() == right
                if inside and not cut and not any(a < m.end() and m.start() < b for _, a, b in base):
                    beside[m.group().lower(), name].append((i, t[left:s] + "|" + t[e:right], m.start(), m.end()))
    around = Counter()
    for (_, name), spots in beside.items():
        around[name] += len(spots)
    total, out, telling = sum(words.values()), defaultdict(set), set()
    for (term, name), spots in beside.items():
        if len({c for _, c, _, _ in spots}) < 2 or len({i for i, _, _, _ in spots}) < 2:
            continue
        information = math.log(total / around[name])
        share = math.log(len(spots) * total / (words[term] * around[name])) / information
        if share >= pii.GENERALISE:
            telling.add((term, name))
    # A telling word goes wherever it stands in a document with the entity.
    for i, t in rows:
        base = spans(t)
        held = {kind + ":" + t[s:e].lower() for kind, s, e in base}
        for m in re.finditer(r"[^\W\d_][^\W_]*", t):
            free = not any(a < m.end() and m.start() < b for _, a, b in base)
            if free and any((m.group().lower(), name) in telling for name in held):
                out[i].add((m.start(), m.end()))
    return out


def test_telling_terms(spark):
    rows = corpus()
    wanted = by_hand(rows)
    assert wanted and all(100 <= i < 104 for i in wanted)
    got = pii.find(table(spark, rows)).collect()
    assert {r.doc_id: {(t.start, t.end) for t in r.terms} for r in got if r.terms} == dict(wanted)


def test_telling_terms_far_from_their_entity(spark):
    """The same words beyond the reach, in documents with and without the entity."""
    rows = corpus()
    far = " and".join(f" word{n}x" for n in range(40))
    rows += [(400, f"Quill wrote{far} z.quill@example.org {far} zephyrine came"), (401, "Only Zephyrine without an address")]
    wanted = by_hand(rows)
    got = {r.doc_id: {(t.start, t.end) for t in r.terms} for r in pii.find(table(spark, rows)).collect() if r.terms}
    assert got == dict(wanted) and (0, 5) in got[400] and 401 not in got


def test_many_matches_take_no_square(spark):
    """Matches of several thousands, their places against a plain search."""
    rows = [(1, "é a@b.cd " * 3000 + "+49 30 1234567 1.2.3.4"), (2, "a@b.cd " * 64), (3, "a@b.cd," * 65), (4, "x 9.9.9.9;" * 129)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(b.kind, b.start, b.end) for b in r.base] for r in pii.find_base(frame).collect()}
    assert got == {i: spans(t) for i, t in rows}


def test_sanitised(spark):
    rows = corpus() + [(300, None), (301, "plain"), (None, "+44 20 7946 0958")]
    docs = table(spark, rows)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[300] is None and texts[301] == "plain" and texts[None] == "[PHONE]"
    assert texts[200] == "the lonelyword beside [PHONE] of prose"
    assert "[EMAIL]" in texts[101] and "Quill" not in texts[101] and "Zephyrine" not in texts[101]
    assert texts[7] == rows[7][1]


def test_overlapping_spans_are_replaced_once(spark):
    rows = [(1, "pay +4111111111111111 to a@b.cd"), (2, "1.2.3.4@host.name")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_base(frame).orderBy("doc_id")
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string,removed:boolean>>)")
    made = [r[0] for r in found.select(pii.sanitised(F.col("text"), F.col("base"), none)).collect()]
    assert "4111" not in made[0] and made[0].endswith("to [EMAIL]") and "host" not in made[1]


def test_only_dataframe_functions(spark):
    plan = pii.find(table(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
