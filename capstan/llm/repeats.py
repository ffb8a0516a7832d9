"""Long repeats across documents: what the byte and the word operator share.

Documents are sampled at anchors (see ``anchors``). An anchor gram that occurs
once clears its windows. Occurrences of a repeated gram fall into classes of
equal context, that is, equal in all windows of the anchor. If a gram has one
class, its windows repeat as they are; where classes differ, an operator's own
method decides window by window on one representative of each class. So copies,
however many, are looked at once. Joins are merge joins at every size: their
sides grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capstan.llm import anchors
from capstan.llm.texts import documents_of, per_batch
from capstan.llm.workspace import Workspace

ANCHOR = "doc_id long, mark long, gram long, context long, place int, first int, last int"
# Runs of repeated windows, by how far before the anchor they start.
RUNS = "gram long, context long, runs array<struct<near int, far int, least long>>"


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, mark, text``: with the hash of its text a repeated id still names its own rows."""
    return documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("mark"), "text")


def anchor_rows(docs: DataFrame, symbols: Callable[[str], np.ndarray], length: int, gram: int) -> DataFrame:
    """One row for each anchor of each document."""

    def make() -> Callable:
        def run(ids: list[int], marks: list[int], texts: list[str]) -> dict:
            found = [anchors.find(symbols(t), length, gram) for t in texts]
            sizes = [len(a.place) for a in found]

            def joined(name: str, dtype: str) -> np.ndarray:
                return np.concatenate([getattr(a, name) for a in found]).astype(np.uint64).view(np.int64).astype(dtype)

            return {
                "doc_id": np.repeat(np.array(ids, np.int64), sizes), "mark": np.repeat(np.array(marks, np.int64), sizes),
                "gram": joined("gram", "i8"), "context": joined("context", "i8"),
                "place": joined("place", "i4"), "first": joined("first", "i4"), "last": joined("last", "i4"),
            }

        return run

    return per_batch(docs, make, ANCHOR)


def repeated_anchors(work: Workspace, rows: DataFrame, across: bool) -> DataFrame:
    """Occurrences of grams that occur again (``across``: in another document), with ``single`` and ``least``.

    ``single``: all occurrences of the gram have one context; ``least`` is the
    smallest document of the gram. Counts are combined before the shuffle, and
    both sides of the join are written tables, so adaptive execution can split
    a hot gram.
    """
    rows = work.store(rows, "anchors")
    groups = rows.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"),
        (F.min("context") == F.max("context")).alias("single"),
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"),
    )
    again = F.col("least") < F.col("most") if across else F.col("n") > 1
    groups = work.store(groups.where(again).select("gram", "single", "least"), "groups")
    found = work.store(rows.join(groups.hint("merge"), "gram"), "repeated")
    work.drop("anchors", "groups")
    return found


def classes(work: Workspace, repeated: DataFrame) -> DataFrame:
    """Classes of the grams that have several: ``n`` members, the ``least`` document, one representative."""
    one = F.min(F.struct("doc_id", "mark", "place", "first", "last")).alias("one")
    grouped = repeated.where("NOT single").groupBy("gram", "context")
    made = grouped.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), one)
    return work.store(made.select("gram", "context", "n", "least", "one.*"), "classes")


def in_texts(kinds: DataFrame, docs: DataFrame) -> DataFrame:
    """``text, found``: each text that holds representatives, with all it holds (as many as it has anchors at most).

    Repeated rows of one id and text are told apart after the join, by keys
    alone, where only texts with representatives are left.
    """
    keys = ["doc_id", "mark"]
    entry = F.struct("gram", "context", "n", "least", "place", "first", "last")
    lists = kinds.groupBy(*keys).agg(F.collect_list(entry).alias("found"))
    held = docs.hint("merge").join(lists, keys)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return held.withColumn("row", first).where("row = 1").select("text", "found")


def spans(repeated: DataFrame, verdicts: DataFrame, across: bool) -> DataFrame:
    """``doc_id, mark, spans``: per document the runs of windows that repeat, as (first, last) window.

    ``across``: only those with a smaller document. Runs that touch are one: the
    anchors' windows follow one another, so a repeated passage becomes a path
    from its first window to its last.
    """
    whole = repeated.where("single").select("doc_id", "mark", "first", "last", "least")
    several = repeated.where("NOT single").select("doc_id", "mark", "gram", "context", "place")
    several = several.join(verdicts.hint("merge"), ["gram", "context"]).select("doc_id", "mark", "place", F.explode("runs").alias("run"))
    several = several.select(
        "doc_id",
        "mark",
        (F.col("place") - F.col("run.far")).alias("first"),
        (F.col("place") - F.col("run.near")).alias("last"),
        F.col("run.least").alias("least"),
    )
    runs = whole.unionByName(several)
    if across:
        runs = runs.where("doc_id > least")
    order = Window.partitionBy("doc_id", "mark").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= reached + 1, 0).otherwise(1)
    paths = runs.withColumn("opens", opens).withColumn("path", F.sum("opens").over(order))
    paths = paths.groupBy("doc_id", "mark", "path").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return paths.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def with_spans(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """``doc_id, text, spans``: stretches of symbols that repeated windows cover, disjoint, in order."""
    joined = docs.join(found.hint("merge"), ["doc_id", "mark"], "left")
    empty = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")
    # Windows of different runs may overlap or touch as stretches.
    merged = F.aggregate(
        F.transform("spans", lambda s: F.struct(s["first"].alias("start"), (s["last"] + length).alias("end"))),
        empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, F.lit(-1))["end"] >= s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(F.element_at(done, F.lit(-1))["start"].alias("start"), s["end"].alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    spans_ = F.when(F.col("spans").isNull(), empty).otherwise(merged)
    return joined.select("doc_id", "text", spans_.alias("spans"))
