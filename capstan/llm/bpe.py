"""Byte-level BPE through a sentencepiece model written straight from the vocabulary."""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from capstan.llm.texts import documents_of
from capstan.llm.words import ends_of, ids_by_word, some_texts
from capstan.session import ship_package

# Field numbers of the sentencepiece model format.
MODEL_PIECES, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TRAINER_MODEL_TYPE, TRAINER_VOCAB_SIZE, TRAINER_UNK, TRAINER_BOS, TRAINER_EOS, TRAINER_PAD = 3, 4, 40, 41, 42, 43
NORMALIZER_NAME, NORMALIZER_PREFIX, NORMALIZER_EXTRA_SPACE, NORMALIZER_ESCAPE = 1, 3, 4, 5
TYPE_NORMAL, TYPE_UNKNOWN = 1, 2
MODEL_TYPE_BPE = 2


def byte_alphabet() -> list[str]:
    """One printable character for each byte: itself if printable Latin-1, else the next from U+0100 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


ALPHABET = byte_alphabet()
_TO_ALPHABET = dict(enumerate(ALPHABET))


def mapped(raw: bytes) -> str:
    """Bytes as characters of the byte alphabet."""
    return raw.decode("latin-1").translate(_TO_ALPHABET)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by id; ranks must be 0..n-1."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks are not 0..n-1")
    return [ranks[i] for i in range(len(ranks))]


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protobuf field: varint, 32-bit float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks.

    Pieces are the tokens in the byte alphabet, scored by negative rank, so the
    best-scored merge is the merge of lowest rank. The unknown piece that the
    format wants comes last. Text is not normalised in any way.
    """
    pieces = [(mapped(token).encode(), -float(rank), TYPE_NORMAL) for rank, token in enumerate(tokens)]
    pieces.append((b"<unk>", 0.0, TYPE_UNKNOWN))
    body = b"".join(
        _field(MODEL_PIECES, _field(PIECE_TEXT, text) + _field(PIECE_SCORE, score) + _field(PIECE_TYPE, kind))
        for text, score, kind in pieces
    )
    trainer = _field(TRAINER_MODEL_TYPE, MODEL_TYPE_BPE) + _field(TRAINER_VOCAB_SIZE, len(pieces))
    trainer += _field(TRAINER_UNK, len(tokens))
    trainer += b"".join(_field(f, -1) for f in (TRAINER_BOS, TRAINER_EOS, TRAINER_PAD))
    normalizer = _field(NORMALIZER_NAME, b"identity")
    normalizer += b"".join(_field(f, 0) for f in (NORMALIZER_PREFIX, NORMALIZER_EXTRA_SPACE, NORMALIZER_ESCAPE))
    return body + _field(MODEL_TRAINER, trainer) + _field(MODEL_NORMALIZER, normalizer)


def _members(code_points: str, of: str) -> set[str]:
    """Characters that a class of a pattern holds, as the tiktoken library knows it."""
    single = {bytes([b]): b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=of, mergeable_ranks=single, special_tokens={})
    return set(bytes(probe.encode_ordinary(code_points)).decode())


@functools.cache
def stand_ins(pattern: str) -> dict[int, int]:
    """For code points that the tiktoken library and the ``regex`` module class differently, one that both class as it does.

    The Unicode tables of both may be of different years. Classes are those that
    the pattern names; a stand-in occurs nowhere in the pattern itself.
    """
    classes = sorted(set(regex.findall(r"\\[pP]\{\^?\w+\}|\\[sSdDwW]", pattern)))
    code_points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    theirs, ours = dict.fromkeys(code_points, 0), dict.fromkeys(code_points, 0)
    for bit, name in enumerate(classes):
        for c in _members(code_points, name):
            theirs[c] |= 1 << bit
        for c in regex.findall(name, code_points):
            ours[c] |= 1 << bit
    # Beyond ASCII, so that none is a letter the pattern spells out.
    alike = {theirs[c]: c for c in reversed(code_points) if ord(c) > 0xFF and theirs[c] == ours[c] and c not in pattern}
    return {ord(c): ord(alike[theirs[c]]) for c in code_points if theirs[c] != ours[c]}


class Splitter:
    """Matches of a pattern in a text, as the tiktoken library finds them."""

    def __init__(self, pattern: str, other: dict[int, int]):
        self._find = regex.compile(pattern)
        self._other = other
        self._odd = frozenset(map(chr, other))

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self._odd.isdisjoint(text):
            return self._find.findall(text)
        return [text[m.start() : m.end()] for m in self._find.finditer(text.translate(self._other))]


class Codec:
    """Encodes pre-tokens with the model and decodes ids by the inverse byte mapping."""

    def __init__(self, tokens: list[bytes], pattern: str, other: dict[int, int] | None = None):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        self._split = Splitter(pattern, stand_ins(pattern) if other is None else other)
        back = {c: b for b, c in enumerate(ALPHABET)}
        pieces = (self._model.id_to_piece(i) for i in range(len(tokens)))
        self._bytes = [bytes(map(back.__getitem__, piece)) for piece in pieces]
        self._whole_tokens = {token: [rank] for rank, token in enumerate(tokens)}

    def _pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens; the different ones go through the model in one call."""
        # A pre-token that is a token stands for itself, however its merges run.
        known = self._whole_tokens
        new = list({p for p in pieces if p not in known})
        found = dict(zip(new, self._model.encode([mapped(p) for p in new], num_threads=1), strict=True))
        return [known.get(p) or found[p] for p in pieces]

    def _whole(self, text: str) -> np.ndarray:
        made = self._pieces([p.encode() for p in self._split(text)])
        return np.fromiter(chain.from_iterable(made), np.uint32)

    def _each(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Splits words as one text and counts the ids up to where each ends."""
        pieces = [p.encode() for p in self._split(" " + " ".join(words.to_pylist()))]
        made = self._pieces(pieces)
        until = np.cumsum(np.fromiter(map(len, made), np.int64, len(made)))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        ids = np.fromiter(chain.from_iterable(made), np.uint32, int(until[-1]))
        return ids, np.diff(until[np.searchsorted(ends, ends_of(words))], prepend=0)

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return [ids.astype("<u4").tobytes() for ids in ids_by_word(texts, self._whole, self._each)]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that some ids stand for."""
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _columns(codec: Codec, texts: pa.StringArray) -> dict[str, list]:
    ids = codec.encode(texts)
    return {"ids": ids, "decoded": [codec.decode(i) for i in ids]}


def _digests(codec: Codec, texts: pa.StringArray) -> dict[str, list]:
    made = _columns(codec, texts)
    return {
        "n_tokens": [len(i) // 4 for i in made["ids"]],
        "ids_sha256": [hashlib.sha256(i).hexdigest() for i in made["ids"]],
        "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in made["decoded"]],
    }


def _encoded(docs: DataFrame, vocabulary: str, pattern: str, columns: Callable, types: str) -> DataFrame:
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(vocabulary), stand_ins(pattern)))
    schema = StructType.fromDDL(f"doc_id long, {types}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, other = shared.value
        codec = Codec(tokens, pattern, other)
        for batch in batches:
            for part in some_texts(batch):
                made = columns(codec, part.column("text"))
                values = [part.column("doc_id"), *[pa.array(v, arrow.field(c).type) for c, v in made.items()]]
                yield pa.RecordBatch.from_arrays(values, schema=arrow)

    return docs.mapInArrow(run, schema)


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, decoded``: ids as little-endian unsigned 32-bit binary, and the bytes they decode to.

    Whole texts, no special tokens, each match of ``pattern`` on its own; the
    pattern must split before a single space, as byte-level patterns do. A null
    text is an empty one, an empty text has no ids; rows without an id take no
    part; repeated rows give repeated rows; an empty table gives an empty one.
    Other columns are not read. No shuffle. The vocabulary file is read on the
    driver and travels with the tasks, its size being fixed by the vocabulary.
    """
    rows = documents_of(docs, id_col, text_col)
    return _encoded(rows, vocabulary, pattern, _columns, "ids binary, decoded binary")


def encoding_digests(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``encode_documents`` with counts and SHA-256 in place of ids and bytes, so that those never leave the task."""
    rows = documents_of(docs, id_col, text_col)
    return _encoded(rows, vocabulary, pattern, _digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")
