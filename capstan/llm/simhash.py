"""SimHash near-duplicates of documents by multi-index hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.llm.components import connected_components
from capstan.llm.texts import documents_of, per_batch
from capstan.llm.workspace import Workspace

SEED = 42
BITS = 64
SHINGLES_AT_ONCE = 1 << 16
SEGMENT = 32
MAX_DISTANCE = 3


def shingles(text: str, length: int) -> list[bytes]:
    """Runs of ``length`` words, A-Z in lower case; the whole sequence if it is shorter, nothing without words."""
    words = text.encode().lower().split()
    if len(words) <= length:
        return [b" ".join(words)] if words else []
    return [b" ".join(run) for run in zip(*(words[i:] for i in range(length)))]


def fingerprint(text: str, length: int) -> int:
    """Bit i is set if over half the shingles have it in their XXH64; as a signed 64-bit integer."""
    parts = shingles(text, length)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(parts), SHINGLES_AT_ONCE):
        some = parts[start : start + SHINGLES_AT_ONCE]
        hashes = np.fromiter((digest(p, SEED) for p in some), "<u8", len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > len(parts), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, length: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark, fingerprint`` (signed 64-bit) of every whole text; zero without words. ``mark`` is a hash of the text."""

    def make():
        return lambda ids, marks, texts: {
            "doc_id": ids, "mark": marks, "fingerprint": [fingerprint(t, length) for t in texts]
        }

    rows = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return per_batch(rows, make, "doc_id long, mark long, fingerprint long")


def _segments(value: Column) -> list[Column]:
    low = F.lit((1 << SEGMENT) - 1)
    return [value.bitwiseAND(low), F.shiftrightunsigned(value, SEGMENT)]


def _ball(value: Column, radius: int) -> Column:
    """``value`` and, for radius 1, what it gives with one set bit cleared.

    Of two segments one bit apart exactly one has the bit, so one of them finds
    the other: half the full ball is enough.
    """
    if not radius:
        return F.array(value)
    ones = F.array(*[F.lit(1 << i).cast("long") for i in range(SEGMENT)])
    cleared = F.transform(F.filter(ones, lambda b: value.bitwiseAND(b) != 0), lambda b: value.bitwiseXOR(b))
    return F.concat(F.array(value), cleared)


def near_fingerprints(values: DataFrame, distance: int) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that differ in 1 to ``distance`` (at most 3) bits.

    Two segments: a pair within 3 bits differs by at most one bit in one of
    them. Each fingerprint stands in the table of either segment and looks up
    the ball around its own segment there; matches count by the distance of all
    bits. Pairs may repeat.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"two segments with a ball of one bit reach {MAX_DISTANCE} bits")
    value = F.col("fingerprint")
    tables, probes = [], []
    for number, segment in enumerate(_segments(value)):
        tag = F.lit(number).cast("byte").alias("segment")
        tables.append(values.select(tag, segment.alias("key"), value.alias("a")))
        probes.append(values.select(tag, F.explode(_ball(segment, min(1, distance // 2))).alias("key"), value.alias("b")))
    matches = tables[0].unionByName(tables[1]).join(probes[0].unionByName(probes[1]).hint("merge"), ["segment", "key"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return matches.where((F.col("a") != F.col("b")) & near).select("a", "b")


def near_duplicates(
    docs: DataFrame, length: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, mark, fingerprint, component_id`` of every row: the least id it reaches over linked fingerprints.

    Fingerprints link at ``distance`` or fewer differing bits; equal ones always
    do. Rows meet only as distinct fingerprints, each standing for its least id,
    so a group of copies of any size is one node. Null and wordless texts have
    fingerprint zero and link like any other. Rows without an id take no part;
    repeated rows give repeated rows; an empty table gives an empty one; other
    columns are not read.
    """
    work = Workspace(docs.sparkSession)
    marked = work.store(fingerprints(docs, length, id_col, text_col), "fingerprints")
    values = work.store(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "values")
    pairs = near_fingerprints(values, distance)
    first = {c: values.select(F.col("fingerprint").alias(c), F.col("first").alias(f"{c}_first")) for c in "ab"}
    links = pairs.distinct().join(first["a"], "a").join(first["b"], "b")
    links = links.select(F.col("a_first").alias("a"), F.col("b_first").alias("b"))
    found = connected_components(work, links)
    classes = values.join(found, F.col("first") == F.col("node"), "left")
    classes = classes.select("fingerprint", F.coalesce("component", "first").alias("component_id"))
    classes = work.store(classes, "classes")
    return marked.join(classes, "fingerprint").select("doc_id", "mark", "fingerprint", "component_id")


def one_of_each(
    docs: DataFrame, length: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row of least id (and text hash) stays.

    Repeated rows count as copies of one another. Rows without an id stay;
    columns go through.
    """
    work = Workspace(docs.sparkSession)
    found = near_duplicates(docs, length, distance, id_col, text_col).where("doc_id = component_id")
    chosen = found.groupBy("component_id").agg(F.min("mark").alias("__mark"))
    chosen = work.store(chosen.withColumnRenamed("component_id", "__id"), "chosen")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.withColumn("__id", id_.cast("long")).withColumn("__mark", F.xxhash64(F.coalesce(text, F.lit(""))))
    kept = rows.join(chosen.hint("merge"), ["__id", "__mark"], "left_semi")
    place = F.row_number().over(Window.partitionBy("__id", "__mark").orderBy("__id"))
    kept = kept.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")
    return kept.unionByName(rows.where(id_.isNull())).drop("__id", "__mark")
