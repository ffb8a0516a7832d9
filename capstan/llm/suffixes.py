"""Removal of long repeated byte strings by deep-shallow sorting of sampled suffixes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from capstan.llm import repeats
from capstan.llm.texts import per_batch
from capstan.llm.workspace import Workspace

WINDOW = 400
GRAM = 100
# Bytes sorted by multikey quicksort, eight at a time, before blind tries take over.
SHALLOW = 128
# Contexts of one gram that one task sorts; a gram with more is dealt out by window.
GROUP = 20_000
# Contexts sorted together, whole groups at a time.
AT_ONCE = 20_000

_SYMBOLS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _symbols(text: str) -> np.ndarray:
    return _SYMBOLS[np.frombuffer(text.encode(), np.uint8)]


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    most = min(len(a), len(b))
    low, step = start, 8
    while low < most:
        if a[low : low + step] == b[low : low + step]:
            low += step
            step *= 2
        elif step == 1:
            return low
        else:
            step = max(1, step // 4)
    return min(low, most)


class BlindTrie:
    """Strings with a common prefix, by the bytes at which they branch.

    A node is ``[place, children by byte]``; the end of a string sorts before
    any byte. A leaf holds equal strings.
    """

    END = -1

    def __init__(self, strings: list[bytes], start: int):
        self._strings, self._start = strings, start
        self._root: list = [[0]]
        for i in range(1, len(strings)):
            self._insert(i)

    @staticmethod
    def _at(string: bytes, place: int) -> int:
        return string[place] if place < len(string) else BlindTrie.END

    def _insert(self, new: int) -> None:
        string = self._strings[new]
        # Down by branching bytes alone, to any leaf where the byte is missing.
        node = self._root
        while len(node) == 2:
            node = node[1].get(self._at(string, node[0])) or next(iter(node[1].values()))
        other = self._strings[node[0][0]]
        split = common(string, other, self._start)
        if split == len(string) == len(other):
            node[0].append(new)
            return
        # Down again, to where the strings really part.
        node = self._root
        while len(node) == 2 and node[0] < split:
            node = node[1][self._at(string, node[0])]
        mine = self._at(string, split)
        if len(node) == 2 and node[0] == split:
            node[1][mine] = [[new]]
        else:
            below = node[:]
            node[:] = [split, {self._at(other, split): below, mine: [[new]]}]

    def order(self) -> tuple[list[int], list[int]]:
        """Strings in order, and what each has in common with the one before it (the first: nothing)."""
        order: list[int] = []
        shared: list[int] = []
        stack: list[tuple[list, int]] = [(self._root, 0)]
        while stack:
            node, before = stack.pop()
            if len(node) == 2:
                keys = sorted(node[1])
                stack += [(node[1][k], node[0]) for k in reversed(keys[1:])]
                stack.append((node[1][keys[0]], before))
            else:
                same = len(self._strings[node[0][0]])
                order += node[0]
                shared += [before] + [same] * (len(node[0]) - 1)
        return order, shared


def deep_shallow(strings: list[bytes], groups: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings within their groups, and the common prefix of each with the one before it.

    Multikey quicksort with keys of eight bytes up to ``shallow``, all segments
    of equal prefix at once; a segment that is left longer than one goes through
    a blind trie. Strings of different groups have nothing (-1) in common.
    """
    n = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    padded = b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings)
    keys = np.frombuffer(padded, ">u8").reshape(n, shallow // 8)
    order = np.argsort(groups, kind="stable")
    shared = np.zeros(n, np.int64)
    segment = groups[order]
    opens = np.append(True, segment[1:] != segment[:-1])
    shared[opens] = -1
    for depth in range(shallow // 8):
        number = np.cumsum(opens)
        alone = opens & np.append(opens[1:], True)
        rest = np.nonzero(~alone)[0]
        if not len(rest):
            break
        key = keys[order[rest], depth].astype(np.uint64)
        by = np.lexsort((key, number[rest]))
        order[rest] = order[rest][by]
        key = key[by]
        parts = ~opens[rest]
        parts[1:] &= key[1:] != key[:-1]
        parts[0] = False
        at = rest[parts]
        differ = key[np.nonzero(parts)[0]] ^ key[np.nonzero(parts)[0] - 1]
        lead = np.floor((64 - _bit_length(differ)) / 8).astype(np.int64)
        shared[at] = np.minimum(8 * depth + lead, np.minimum(lengths[order[at]], lengths[order[at - 1]]))
        opens[at] = True
    starts = np.nonzero(opens)[0]
    ends = np.append(starts[1:], n)
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        members = order[s:e]
        # Equal keys may hide the end of a string behind zero bytes.
        known = min(shallow, int(lengths[members].min()))
        placed, inner = BlindTrie([strings[i] for i in members.tolist()], known).order()
        order[s:e] = members[placed]
        shared[s + 1 : e] = inner[1:]
    return order, shared


def _bit_length(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    left = values.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        big = left >= np.uint64(1) << np.uint64(shift)
        out[big] += shift
        left[big] >>= np.uint64(shift)
    return out + (left > 0)


def repeated_windows(
    groups: np.ndarray, befores: list[bytes], afters: list[bytes], near: np.ndarray, counts: np.ndarray, window: int
) -> np.ndarray:
    """For each context, which windows occur again: row i, column x for the one that starts x bytes before the anchor.

    A context is the bytes before its anchor, last one first, and those from the
    anchor on; it has the windows from ``near`` on as far back as it reaches.
    Both sides are sorted. Contexts share window x if they lie in one run of
    prefixes of length ``window - x`` on one side and of length x on the other.
    """
    n = len(groups)
    far = np.array([len(b) for b in befores])
    after, after_shared = deep_shallow(afters, groups)
    before, before_shared = deep_shallow(befores, groups)
    out = np.zeros((n, window + 1), bool)
    ahead, behind = np.empty(n, np.int64), np.empty(n, np.int64)
    for x in range(int(near.min()), int(far.max()) + 1):
        able = np.nonzero((near <= x) & (x <= far))[0]
        if not len(able):
            continue
        ahead[after] = np.cumsum(after_shared < window - x)
        behind[before] = np.cumsum(before_shared < x)
        key = ahead[able] * (n + 1) + behind[able]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        again = np.zeros(len(able), bool)
        again[by[1:]] |= same
        again[by[:-1]] |= same
        out[able, x] = again | (counts[able] > 1)
    return out


def _contexts(docs: DataFrame, kinds: DataFrame, window: int) -> DataFrame:
    """Bytes on both sides of the representatives' anchors."""

    def make() -> Callable:
        def run(texts: list[str], found: list[list[dict]]) -> dict:
            out: dict[str, list] = {c: [] for c in ("gram", "context", "n", "near", "before", "after")}
            for text, anchors in zip(texts, found, strict=True):
                raw = text.encode()
                for a in anchors:
                    for c in ("gram", "context", "n"):
                        out[c].append(a[c])
                    out["near"].append(a["place"] - a["last"])
                    out["before"].append(raw[a["first"] : a["place"]][::-1])
                    out["after"].append(raw[a["place"] : a["last"] + window])
            return out

        return run

    schema = "gram long, context long, n long, near int, before binary, after binary"
    return per_batch(repeats.in_texts(kinds, docs), make, schema)


def _runs_of(again: np.ndarray) -> list[list[dict]]:
    edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, nears = np.nonzero(edge == 1)
    _, fars = np.nonzero(edge == -1)
    out: list[list[dict]] = [[] for _ in range(len(again))]
    for row, near, far in zip(rows.tolist(), nears.tolist(), fars.tolist(), strict=True):
        out[row].append({"near": near, "far": far - 1, "least": None})
    return out


def _sorted_verdicts(contexts: DataFrame, window: int) -> DataFrame:
    """Sorts the contexts of whole grams, some grams at a time."""
    schema = StructType.fromDDL(repeats.RUNS)
    arrow = to_arrow_schema(schema)

    def decide(rows: list[dict]) -> pa.RecordBatch:
        number = np.unique([r["gram"] for r in rows], return_inverse=True)[1]
        again = repeated_windows(
            number, [r["before"] for r in rows], [r["after"] for r in rows],
            np.array([r["near"] for r in rows]), np.array([r["n"] for r in rows]), window,
        )
        made = [
            {"gram": r["gram"], "context": r["context"], "runs": runs}
            for r, runs in zip(rows, _runs_of(again), strict=True)
            if runs
        ]
        return pa.RecordBatch.from_pylist(made, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(waiting) >= AT_ONCE and row["gram"] != waiting[-1]["gram"]:
                    yield decide(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield decide(waiting)

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, schema)


def _dealt_verdicts(contexts: DataFrame, window: int) -> DataFrame:
    """For grams with more contexts than one task sorts: windows dealt out by 128 bits of their bytes."""

    def make() -> Callable:
        def run(grams: list, contexts: list, counts: list, nears: list, befores: list, afters: list) -> dict:
            out: dict[str, list] = {c: [] for c in ("gram", "context", "n", "back", "high", "low")}
            for gram, context, n, near, before, after in zip(grams, contexts, counts, nears, befores, afters, strict=True):
                raw, place = before[::-1] + after, len(before)
                for back in range(near, place + 1):
                    digest = xxhash.xxh3_128_digest(raw[place - back : place - back + window])
                    out["high"].append(int.from_bytes(digest[:8], "little", signed=True))
                    out["low"].append(int.from_bytes(digest[8:], "little", signed=True))
                    out["back"].append(back)
                    out["gram"].append(gram)
                    out["context"].append(context)
                    out["n"].append(n)
            return out

        return run

    rows = per_batch(contexts, make, "gram long, context long, n long, back int, high long, low long")
    counts = rows.groupBy("high", "low").agg(F.sum("n").alias("total")).where("total > 1").select("high", "low")
    one = F.struct(F.col("back").alias("near"), F.col("back").alias("far"), F.lit(None).cast("long").alias("least"))
    found = rows.join(counts, ["high", "low"]).groupBy("gram", "context")
    return found.agg(F.collect_list(one).alias("runs"))


def repeated_strings(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, text, spans``: stretches of UTF-8 bytes covered by strings of ``window`` bytes that start elsewhere too.

    Elsewhere is any other place, the same document included; strings never
    cross documents and are judged on the input. Suffixes are sampled at anchors
    (any window holds one), those whose gram occurs once are dropped by a join,
    and the rest are sorted on both sides of the anchor, one of each context,
    by multikey quicksort and blind tries; neighbours in the orders tell which
    windows repeat. Groups of more than ``group`` contexts are not put into one
    task: their windows are dealt out by hash and counted. Either way is exact.

    A null text is empty; a text shorter than a window has no spans; repeated
    rows are copies of one another and give repeated rows; rows without an id
    take no part; an empty table gives an empty one; other columns are not read.
    """
    work = Workspace(docs.sparkSession)
    docs = repeats.marked(docs, id_col, text_col)
    found = repeats.repeated_anchors(work, repeats.anchor_rows(docs, _symbols, window, gram), across=False)
    kinds = repeats.classes(work, found)
    contexts = work.store(_contexts(docs, kinds, window), "contexts")
    sizes = kinds.groupBy("gram").count()
    large = work.store(sizes.where(F.col("count") > group).select("gram"), "large")
    verdicts = _sorted_verdicts(contexts.join(large, "gram", "left_anti"), window)
    if not large.isEmpty():
        verdicts = verdicts.unionByName(_dealt_verdicts(contexts.join(large, "gram", "left_semi"), window))
    verdicts = work.store(verdicts, "verdicts")
    paths = work.store(repeats.spans(found, verdicts, across=False), "paths")
    work.drop("repeated", "classes", "contexts", "large", "verdicts")
    return repeats.with_spans(docs, paths, window)


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the bytes outside ``repeated_strings``, in order."""

    def make() -> Callable:
        def run(ids: list[int], texts: list[str], spans: list[list[dict]]) -> dict:
            sizes, kept = [], []
            for text, gone in zip(texts, spans, strict=True):
                raw = text.encode()
                ends = [0, *[s["end"] for s in gone]]
                starts = [*[s["start"] for s in gone], len(raw)]
                sizes.append(len(raw))
                kept.append(b"".join(raw[e:s] for e, s in zip(ends, starts, strict=True)))
            return {"doc_id": ids, "n_bytes": sizes, "spans": spans, "kept": kept}

        return run

    found = repeated_strings(docs, window, gram, group, id_col, text_col)
    return per_batch(found, make, "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
