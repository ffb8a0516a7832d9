"""Lexical retrieval packing: sequences of documents that share rare words."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from capstan.llm.bpe import ALPHABET
from capstan.llm.texts import documents_of
from capstan.llm.words import ends_of, ids_by_word, some_texts
from capstan.llm.workspace import Workspace

# Documents of one index shard: neighbours in the lexical order, so likely to share words.
SHARD_DOCUMENTS = 2048
# A seed asks for its terms of highest weight; those shared with half the shard say little.
QUERY_TERMS = 24
K1, B = 1.2, 0.75
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
# Sequence ids: the task, then the sequence in it.
_SEQUENCE_SHIFT = 40

# Fixed value: how the byte-level tokenizer file splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _tokenizer_file(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def read_special(path: str) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` file, each of which is one id wherever its text occurs."""
    tokens = _tokenizer_file(path)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
        raise ValueError("added tokens that depend on what surrounds them")
    return {t["content"]: t["id"] for t in tokens}


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Byte tokens and their ids from a byte-level ``tokenizers`` file.

    Merges must have ids in their order, so that an id is also a merge rank;
    special tokens have no entry.
    """
    tokenizer = _tokenizer_file(path)
    model = tokenizer["model"]
    back = {c: b for b, c in enumerate(ALPHABET)}
    special = {t["content"] for t in tokenizer["added_tokens"]}
    merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
    ranks = [model["vocab"][m] for m in merged]
    if ranks != sorted(ranks):
        raise ValueError("merge order and ids differ")
    return {bytes(map(back.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}


class Words:
    """Ids of whole texts."""

    def __init__(self, vocabulary: dict[bytes, int], special: dict[str, int] | None = None):
        self._special = special or {}
        self._specials = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")")
        self._encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self._sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self._sizes[number] = len(token)

    def _whole(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, disallowed_special=())

    def _around_specials(self, text: str) -> np.ndarray:
        """What lies between special tokens is encoded by itself."""
        parts = [p for p in self._specials.split(text) if p]
        made = [np.array([self._special[p]], np.uint32) if p in self._special else self._whole(p) for p in parts]
        return np.concatenate(made)

    def _each(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Encodes words as one text and counts the ids up to where each ends."""
        ids = self._whole(" " + " ".join(words.to_pylist()))
        ends = np.cumsum(self._sizes[ids])
        return ids, np.diff(np.searchsorted(ends, ends_of(words)) + 1, prepend=0)

    def encode(self, texts: pa.StringArray) -> list[np.ndarray]:
        out = ids_by_word(texts, self._whole, self._each)
        for content in self._special:
            for i in np.nonzero(pc.match_substring(texts, content).to_numpy(zero_copy_only=False))[0].tolist():
                out[i] = self._around_specials(texts[i].as_py())
        return out


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _encoded(
    docs: DataFrame, vocabulary: dict[bytes, int], special: dict[str, int], window: int, end_id: int
) -> DataFrame:
    """Each document's whole windows as checksums, the ids of what remains, and its two highest ids.

    Byte-pair ids rise as tokens get rarer, so documents with a high id in
    common share a rare word.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, special))

    schema = StructType.fromDDL(
        "doc_id long, doc_tokens long, whole array<long>, tail binary, rare long, second long"
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*shared.value)
        for batch in batches:
            for part in some_texts(batch):
                out: dict[str, list] = {c: [] for c in schema.names[1:]}
                for encoded in words.encode(part.column("text")):
                    ids = np.append(encoded, np.uint32(end_id)).astype("<u4")
                    full = len(ids) // window
                    raw = ids.tobytes()
                    out["doc_tokens"].append(len(ids))
                    out["whole"].append([zlib.crc32(raw[4 * window * i : 4 * window * (i + 1)]) for i in range(full)])
                    tail = ids[window * full :]
                    out["tail"].append(tail.tobytes())
                    rare = int(tail.max(initial=0))
                    out["rare"].append(rare)
                    out["second"].append(int(tail[tail < rare].max(initial=0)))
                columns = [part.column("doc_id"), *[pa.array(v, arrow.field(c).type) for c, v in out.items()]]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def document_frequencies(tails: DataFrame) -> DataFrame:
    """``term, n``: units that hold a term, over all units; each task counts its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        units = tokens = 0
        for batch in batches:
            for tail in batch.column(0).to_pylist():
                terms = np.unique(np.frombuffer(tail, "<u4"))
                if len(terms):
                    grown = max(len(total), int(terms[-1]) + 1)
                    total = np.pad(total, (0, grown - len(total)))
                    total[terms] += 1
                    units += 1
                    tokens += len(tail) // 4
        found = np.nonzero(total)[0]
        # Two rows beside the terms: the units and their tokens.
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([*found.tolist(), -1, -2], pa.int64()), "n": pa.array([*total[found].tolist(), units, tokens], pa.int64())}
        )

    return tails.select("tail").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Statistics:
    """Inverse document frequencies by term and the mean length, over all units."""

    def __init__(self, rows: list):
        counts = {r["term"]: r["n"] for r in rows}
        units = counts.pop(-1, 0)
        self.mean = max(1.0, counts.pop(-2, 0) / max(1, units))
        self.idf = np.zeros(max(counts, default=0) + 1)
        for term, n in counts.items():
            self.idf[term] = np.log1p((units - n + 0.5) / (n + 0.5))


def _weights(ids: np.ndarray, statistics: Statistics) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a unit and their BM25 weights."""
    terms, tf = np.unique(ids, return_counts=True)
    base = K1 * (1 - B + B * len(ids) / statistics.mean)
    return terms, statistics.idf[terms] * tf * (K1 + 1) / (tf + base)


class Shard:
    """A BM25 inverted index over the units of one shard."""

    def __init__(self, units: list[np.ndarray], statistics: Statistics):
        weighted = [_weights(ids, statistics) for ids in units]
        sizes = [len(t) for t, _ in weighted]
        terms = np.concatenate([t for t, _ in weighted])
        weights = np.concatenate([w for _, w in weighted])
        owners = np.repeat(np.arange(len(units)), sizes)
        order = np.argsort(terms, kind="stable")
        self._owners, self._weights = owners[order], weights[order]
        listed, starts = np.unique(terms[order], return_index=True)
        ends = np.append(starts[1:], len(terms))
        self._lists = {t: (s, e) for t, s, e in zip(listed.tolist(), starts.tolist(), ends.tolist(), strict=True)}
        self._queries = []
        for unit_terms, unit_weights in weighted:
            best = np.lexsort((unit_terms, -unit_weights))[:QUERY_TERMS]
            self._queries.append(unit_terms[best].tolist())
        self._units = len(units)

    def neighbours(self, seed: int, unused: np.ndarray) -> list[int]:
        """Unused units that share a term with the seed, best score first, ties in shard order."""
        spans = [self._lists[t] for t in self._queries[seed]]
        owners = np.concatenate([self._owners[s:e] for s, e in spans])
        weights = np.concatenate([self._weights[s:e] for s, e in spans])
        scores = np.bincount(owners, weights, self._units)
        found = np.nonzero((scores > 0) & unused)[0]
        return found[np.argsort(-scores[found], kind="stable")].tolist()


def pack(units: list[np.ndarray], statistics: Statistics, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of ``(unit, start, length)``.

    The longest unused unit seeds a sequence; its neighbours fill it, best
    first, then the next unused ones in shard order. What does not fit stays
    unused, so every sequence but the last is full. The last is cut into
    sequences whose lengths are powers of two: nothing is padded.
    """
    left = np.array([len(u) for u in units])
    done = np.zeros(len(units), np.int64)
    index = Shard(units, statistics)
    order = np.argsort(-left, kind="stable").tolist()
    following = 0

    def take(sequence: list, unit: int, room: int) -> int:
        size = min(int(left[unit]), room)
        sequence.append((unit, int(done[unit]), size))
        left[unit] -= size
        done[unit] += size
        return room - size

    for seed in order:
        while left[seed]:
            sequence: list[tuple[int, int, int]] = []
            room = take(sequence, seed, window)
            for unit in index.neighbours(seed, left > 0) if room else []:
                if not room:
                    break
                room = take(sequence, unit, room)
            while room and following < len(units):
                if left[following]:
                    room = take(sequence, following, room)
                else:
                    following += 1
            yield from [sequence] if not room else _powers(sequence, window - room)


def _powers(sequence: list[tuple[int, int, int]], size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Cuts a short sequence where the binary digits of its size say."""
    rest = list(reversed(sequence))
    for bit in reversed(range(size.bit_length())):
        room, part = size & 1 << bit, []
        while room:
            unit, start, length = rest.pop()
            used = min(length, room)
            part.append((unit, start, used))
            if used < length:
                rest.append((unit, start + used, length - used))
            room -= used
        if part:
            yield part


def _packed(ordered: DataFrame, statistics, window: int) -> DataFrame:
    schema = StructType.fromDDL(PIECES)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _SEQUENCE_SHIFT
        made = 0

        def shard(rows: list[dict]) -> pa.RecordBatch:
            nonlocal made
            out = []
            for row in rows:
                for i, checksum in enumerate(row["whole"]):
                    out.append((row["doc_id"], i * window, window, checksum, row["doc_tokens"], first + made, 0))
                    made += 1
            units = [(r, np.frombuffer(r["tail"], "<u4")) for r in rows if r["tail"]]
            for sequence in pack([ids for _, ids in units], statistics.value, window) if units else ():
                offset = 0
                for unit, start, length in sequence:
                    row, ids = units[unit]
                    begin = len(row["whole"]) * window + start
                    checksum = crc(ids[start : start + length])
                    out.append((row["doc_id"], begin, length, checksum, row["doc_tokens"], first + made, offset))
                    offset += length
                made += 1
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow)

        waiting: list[dict] = []
        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= SHARD_DOCUMENTS:
                yield shard(waiting[:SHARD_DOCUMENTS])
                waiting = waiting[SHARD_DOCUMENTS:]
        if waiting:
            yield shard(waiting)

    return ordered.select("doc_id", "doc_tokens", "whole", "tail").mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    window: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``window`` tokens.

    A document is its ids and ``end_id``; its whole windows are sequences of
    their own and what remains is a unit for packing. Units are ordered by
    their two rarest ids and dealt out in that order, which splits a hot one;
    consecutive runs of ``SHARD_DOCUMENTS`` make the shards of the
    index. Term counts and the mean length cover all units; they have a row per
    id of the vocabulary, which bounds what reaches the driver.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``; every id lies in exactly one piece. A null or empty text has the
    one id ``end_id``; rows without an id take no part; each repeated row is a
    document of its own; an empty table gives an empty one; other columns are
    not read. ``tokenizer`` is a byte-level ``tokenizers`` file, read on the
    driver.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    vocabulary = read_vocabulary(tokenizer)
    documents, special = documents_of(docs, id_col, text_col), read_special(tokenizer)
    encoded = work.store(_encoded(documents, vocabulary, special, window, end_id), "encoded")
    statistics = spark.sparkContext.broadcast(Statistics(document_frequencies(encoded).collect()))
    order = ("rare", "second", "doc_id")
    return _packed(encoded.repartitionByRange(*order).sortWithinPartitions(*order), statistics, window)
