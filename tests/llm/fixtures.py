"""Small documents with the hard cases in them."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(words))


def awkward() -> list[tuple]:
    """Null, empty, wordless, long, repeated, non-ASCII and partly equal texts; a row without an id."""
    passage, other = prose(1, 130), prose(2, 90)
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, prose(3, 10) + " " + passage + " " + prose(4, 20)),
        (5, passage + "\n" + other),
        (6, prose(5, 5) + " " + other + " " + prose(6, 9) + " " + passage),
        (7, "word " * 700),
        (8, prose(7, 4000)),
        (9, prose(7, 4000)),
        (10, "Ünïcödé 😀 " * 60 + passage),
        (10, prose(8, 40)),
        (11, prose(9, 30)),
        (11, prose(9, 30)),
        (12, other + "\u0001   x  y   z\r\n\r\n" + passage[:450]),
        (13, "a" * 900),
        (None, passage),
    ]
    return rows


def table(spark, rows: list[tuple], partitions: int = 3):
    """Rows with further columns whose names operators use themselves."""
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    for name in ("mark", "gram", "key", "block", "base", "terms", "spans", "keep", "n_lines", "fingerprint"):
        docs = docs.withColumn(name, F.lit(name))
    return docs


def texts_of(rows: list[tuple]) -> list[tuple[int, str]]:
    return [(i, t or "") for i, t in rows if i is not None]


def in_order(frame, *columns: str) -> list[tuple]:
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())
