"""Repeated passages of many words, by compaction of a sampled de Bruijn graph."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm import repeats
from capstan.llm.texts import per_batch
from capstan.llm.workspace import Workspace

WINDOW = 50
GRAM = 25


def words(text: str) -> list[bytes]:
    """Words are runs of anything but ASCII white space."""
    return text.encode().split()


def _symbols(text: str) -> np.ndarray:
    parts = words(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))


def _edges(docs: DataFrame, kinds: DataFrame, window: int) -> DataFrame:
    """The windows around branching nodes, one row each: where they stand, and 128 bits of their words."""

    def make() -> Callable:
        def run(texts: list[str], found: list[list[dict]]) -> dict:
            out: dict[str, list] = {c: [] for c in ("gram", "context", "back", "high", "low", "least")}
            for text, anchors in zip(texts, found, strict=True):
                parts = words(text)
                for a in anchors:
                    for start in range(a["first"], a["last"] + 1):
                        digest = xxhash.xxh3_128_digest(b" ".join(parts[start : start + window]))
                        out["high"].append(int.from_bytes(digest[:8], "little", signed=True))
                        out["low"].append(int.from_bytes(digest[8:], "little", signed=True))
                        out["back"].append(a["place"] - start)
                    n = a["last"] - a["first"] + 1
                    for c in ("gram", "context", "least"):
                        out[c] += [a[c]] * n
            return out

        return run

    schema = "gram long, context long, back int, high long, low long, least long"
    return per_batch(repeats.in_texts(kinds, docs), make, schema)


def _runs(edges: DataFrame) -> DataFrame:
    """Edges of a node with the same first document, one after the other, as one run."""

    def make() -> Callable:
        def run(grams: list[int], contexts: list[int], edges: list[list[dict]]) -> dict:
            made = []
            for several in edges:
                runs: list[dict] = []
                for e in several:
                    if runs and runs[-1]["far"] + 1 == e["back"] and runs[-1]["least"] == e["least"]:
                        runs[-1]["far"] = e["back"]
                    else:
                        runs.append({"near": e["back"], "far": e["back"], "least": e["least"]})
                made.append(runs)
            return {"gram": grams, "context": contexts, "runs": made}

        return run

    # A node has at most as many edges as a window has grams.
    lists = edges.groupBy("gram", "context").agg(F.sort_array(F.collect_list(F.struct("back", "least"))).alias("edges"))
    return per_batch(lists, make, repeats.RUNS)


def repeated_passages(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text, spans``: stretches of words covered by windows that a document of smaller id has too.

    Windows of ``window`` words are the edges of a de Bruijn graph; its nodes are
    sampled, as any window holds one sampled ``gram`` of words. Nodes that occur
    in one document alone go by a join with the node counts. A node whose
    occurrences all have the same edges does not branch: its edges follow its
    smallest document, and per document they compact with their neighbours into
    one path. The edges around branching nodes are compared by their words, each
    different surrounding once, and join the paths where they repeat. Words at
    the source coordinates are hashed with 128 bits for this.

    Windows are judged on the input, not on what is left. A null text has no
    words; a text shorter than a window has no spans; repeated rows of one id do
    not count against one another and give repeated rows; rows without an id
    take no part; an empty table gives an empty one; other columns are not read.
    """
    work = Workspace(docs.sparkSession)
    docs = repeats.marked(docs, id_col, text_col)
    nodes = repeats.repeated_anchors(work, repeats.anchor_rows(docs, _symbols, window, gram), across=True)
    kinds = repeats.classes(work, nodes)
    edges = work.store(_edges(docs, kinds, window), "edges")
    first = work.store(edges.groupBy("high", "low").agg(F.min("least").alias("least")), "first")
    decided = edges.drop("least").join(first, ["high", "low"])
    verdicts = work.store(_runs(decided), "verdicts")
    paths = work.store(repeats.spans(nodes, verdicts, across=True), "paths")
    work.drop("repeated", "classes", "edges", "first", "verdicts")
    return repeats.with_spans(docs, paths, window)


def without_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, spans, kept``: the words outside ``repeated_passages``, joined by one space."""

    def make() -> Callable:
        def run(ids: list[int], texts: list[str], spans: list[list[dict]]) -> dict:
            sizes, kept = [], []
            for text, gone in zip(texts, spans, strict=True):
                parts = words(text)
                sizes.append(len(parts))
                for s in reversed(gone):
                    del parts[s["start"] : s["end"]]
                kept.append(b" ".join(parts).decode())
            return {"doc_id": ids, "n_words": sizes, "spans": spans, "kept": kept}

        return run

    found = repeated_passages(docs, window, gram, id_col, text_col)
    return per_batch(found, make, "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept string")
