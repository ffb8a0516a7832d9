"""Licence scans against plain searches, expressions against Python's own evaluation."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capstan.llm import licences, queries
from tests.llm.fixtures import awkward, in_order, table, texts_of

LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(LOWER))


def places(text, phrases):
    words = words_of(text)
    return sorted(
        (i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
    )


def scanned(text):
    scanner = licences.Scanner(licences.BASE_PHRASES, licences.NOTICE_PHRASES, licences.TAGS)
    return scanner.scan(scanner.automaton(), text)


def postfix(text):
    return [(w, e and " ".join(e.postfix)) for w, e in scanned(text)["expressions"]]


LICENCED = [
    "Released under the MIT License. mit  LICENSE mit-license, permit license",
    "Licensed under the Apache License, Version 2.0.",
    "GNU Lesser General Public License; GNU General\nPublic  License general public license",
    "Licensed under CC BY-NC 4.0.",
    "mit license mit license mit license apache license",
    "é mit license, émit license mit licenseé  mit license 0mit license",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nmit",
    "SPDX-License-Identifier: (MIT",
    "word " * 50_000 + "mit license",
    "mit license " * 3000,
]


def test_base_places(spark):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(LICENCED)]
    got = licences.scan(table(spark, rows)).collect()
    assert sorted(
        (r.doc_id, r.n_words, tuple((b.word, b.label) for b in r.base)) for r in got
    ) == sorted((i, len(words_of(t)), tuple(places(t, licences.BASE_PHRASES))) for i, t in texts_of(rows))


def test_digest(spark, tmp_path):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(LICENCED)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_license_scan(spark, str(tmp_path))
    want = []
    for i, text in texts_of(rows):
        base = places(text, licences.BASE_PHRASES)
        at = [w for w, _ in base]
        labels = ",".join(sorted({x for _, x in base}))
        want.append((i, len(words_of(text)), len(base), min(at) if at else -1, max(at) if at else -1, labels))
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert in_order(got.fillna(-1, ["first_word", "last_word"]), *columns) == sorted(want)
    for r in got.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.permissive is not None) or "malformed" in r.labels


@pytest.mark.parametrize(
    ("text", "labels", "permissive", "score"),
    [
        ("", "", None, 0.0),
        ("plain prose about a license", "", None, 0.0),
        ("GNU General Public License, version 3", "gpl", False, 0.5),
        ("Lesser General Public License", "gpl,lgpl", False, 0.75),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc", False, 0.5),
        ("SPDX-License-Identifier: MIT OR GPL-3.0-or-later", "gpl,mit", True, 1.0),
        ("SPDX-License-Identifier: MIT AND GPL-3.0+", "gpl,mit", False, 1.0),
        ('"SPDX-License-Identifier": "GPL-2.0 WITH Classpath-exception-2.0"', "exception,gpl", True, 1.0),
        ("spdx-license-identifier: LicenseRef-Acme", "other", False, 1.0),
        ("SPDX-License-Identifier: MIT OR", "malformed", False, 0.0),
        ("SPDX-License-Identifier:", "malformed", False, 0.0),
        ("It is released under BSD-3-Clause or MIT terms.", "bsd,mit", True, 1.0),
        ("It was released under pressure", "", None, 0.0),
        ("mitigation, apached", "", None, 0.0),
    ],
)
def test_labels(text, labels, permissive, score):
    found = scanned(text)
    made = (",".join(licences._labels(found)), licences._permissive(found), licences._score(found))
    assert made == (labels, permissive, score)


def test_expressions():
    assert postfix("SPDX-License-Identifier: a or b and c with d or (e or f) and g") == [(0, "a b c d with and or e f or g and or")]
    assert postfix("x SPDX-License-Identifier: MIT */ code (mit)") == [(1, "mit")]
    assert postfix("x\nSPDX-License-Identifier: MIT\nApache-2.0") == [(1, "mit")]
    for bad in ("(a", "a and", "and a", "a with (b)", "(a) with b", "a with b with c", "(a b)", "()", "a or or b", ")"):
        assert postfix(f"SPDX-License-Identifier: {bad}") == [(0, None)], bad
    for cut in ("a b", "a (b or c)", "a) b"):
        assert postfix(f"SPDX-License-Identifier: {cut}") == [(0, "a")], cut
    assert postfix("licensed under (mit or apache-2.0) and more, released under the isc.") == [(0, "mit apache-2.0 or"), (9, "isc")]


def test_families():
    names = {"mit": "mit", "mit-0": "mit", "mitre": "other", "lgpl-2.1+": "lgpl", "cc-by-nc-sa-4.0": "cc-by-nc-sa", "gpl2": "gpl"}
    assert {n: licences.family(n) for n in names} == names


@st.composite
def expressions(draw, depth=4):
    if not depth or draw(st.booleans()):
        return draw(st.sampled_from(["mit", "gpl-3.0", "isc", "mpl-2.0"]))
    left, right = draw(expressions(depth=depth - 1)), draw(expressions(depth=depth - 1))
    joined = f"{left} {draw(st.sampled_from(['and', 'or']))} {right}"
    return f"({joined})" if draw(st.booleans()) else joined


@given(expressions(), st.sets(st.sampled_from(["mit", "gpl", "isc", "mpl"])))
@settings(max_examples=300, deadline=None)
def test_values(text, good):
    made = licences.parse(re.findall(r"[()]|[^\s()]+", text))
    plain = re.sub(r"[a-z]+(-[\d.]+)?", lambda m: m[0] if m[0] in ("and", "or") else str(licences.family(m[0]) in good), text)
    assert made.allowed(lambda label, exception: label in good) == eval(plain)


@given(st.lists(st.sampled_from(["a", "b", "and", "or", "with", "(", ")"]), max_size=12))
@settings(max_examples=500, deadline=None)
def test_any_tokens(tokens):
    made = licences.parse(tokens)
    if made:
        assert isinstance(made.allowed(lambda label, exception: True), bool) and made.labels()


def test_own_phrases_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b a b a")], "id long, body string")
    got = licences.scan(docs, {"a b a": "x", "b": "y"}, {}, {}, "id", "body").first()
    assert [tuple(b) for b in got.base] == [(0, "x"), (1, "y"), (2, "x"), (3, "y")] and got.labels == ["x", "y"]
    assert licences.scan(docs, {}, {}, {}, "id", "body").first().n_words == 5
    assert licences.scan(docs.where(F.lit(False)), id_col="id", text_col="body").count() == 0
