"""Tokenizers as Column functions, sub-words as an Arrow UDF."""

from __future__ import annotations

import os
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from capstan.functions.slices import by_slices

# The white space that Java and RE2 patterns both understand, the
# word and character patterns, and the separator of joined grams. The separator
# counts as white space, so no token can contain it.
WHITE_SPACE = r"[ \t\n\r\f\x0B\x1C-\x1F]+"
WORD = r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r\f\x0B\x1C-\x1F]"
CHARACTER = r"[^ \t\n\r\f\x0B\x1C-\x1F]"
GRAM_SEPARATOR = "\x1f"


def whitespace_tokens(text: Column | str) -> Column:
    return F.array_remove(F.split(text, WHITE_SPACE), "")


def first_whitespace_tokens(text: Column | str, count: int) -> Column:
    """The first ``count`` tokens; the rest of a long text is not taken apart."""
    # One empty piece may stand in front, and the last one is the rest.
    pieces = F.slice(F.split(text, WHITE_SPACE, count + 2), 1, count + 1)
    return F.slice(F.array_remove(pieces, ""), 1, count)


def word_tokens(text: Column | str) -> Column:
    """Runs of letters or digits, and every other visible character alone."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def char_tokens(text: Column | str) -> Column:
    """Every visible character; the sound choice for text without spaces."""
    return F.regexp_extract_all(text, F.lit(CHARACTER), F.lit(0))


@lru_cache(maxsize=4)
def _load_subword(path: str):
    # One load per Python worker; Spark already runs one worker per core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (
            lambda texts: model.encode(texts, num_threads=1),
            lambda texts: model.encode(texts, out_type=str, num_threads=1),
            lambda ids: model.decode(ids),
        )
    import tokenizers

    model = tokenizers.Tokenizer.from_file(path)
    model.encode_special_tokens = True
    suffix = getattr(model.model, "end_of_word_suffix", None)
    if suffix and model.decoder is None:
        model.decoder = tokenizers.decoders.BPEDecoder(suffix=suffix)
    return (
        lambda texts: [e.ids for e in model.encode_batch(texts, add_special_tokens=False)],
        lambda texts: [e.tokens for e in model.encode_batch(texts, add_special_tokens=False)],
        lambda ids: model.decode_batch(ids, skip_special_tokens=True),
    )


def _present(values) -> list:
    return ["" if value is None else value for value in values]


def subword_ids(text: Column | str, path: str) -> Column:
    """Token ids of a tokenizer file, whole texts, no special tokens added."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return by_slices(lambda t: _load_subword(path)[0](_present(t)), pa.list_(pa.int32()), texts)

    return encode(text)


def subword_tokens(text: Column | str, path: str) -> Column:
    @F.arrow_udf("array<string>")
    def pieces(texts: pa.Array) -> pa.Array:
        return by_slices(lambda t: _load_subword(path)[1](_present(t)), pa.list_(pa.string()), texts)

    return pieces(text)


def subword_lines(text: Column | str, path: str) -> Column:
    """Sub-words of every line of a text."""

    @F.arrow_udf("array<array<string>>")
    def pieces(texts: pa.Array) -> pa.Array:
        lines = lambda t: [_load_subword(path)[1](text.split("\n")) for text in _present(t)]
        return by_slices(lines, pa.list_(pa.list_(pa.string())), texts)

    return pieces(text)


def subword_text(ids: Column | str, path: str) -> Column:
    """Ids back to text; negative fill ids and special tokens are skipped."""

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        clean = [[int(i) for i in row if i >= 0] if row is not None else [] for row in rows]
        return pd.Series(_load_subword(path)[2](clean))

    return decode(ids)


def tokenize(text: Column | str, kind: str = "whitespace", path: str | None = None) -> Column:
    """Tokens of a text by ``whitespace``, ``word``, ``char`` or ``subword``."""
    if kind == "whitespace":
        return whitespace_tokens(text)
    if kind == "word":
        return word_tokens(text)
    if kind == "char":
        return char_tokens(text)
    if kind == "subword":
        if path is None:
            raise ValueError("the subword tokenizer needs the path of a tokenizer file")
        return subword_tokens(text, path)
    raise ValueError(f"unknown tokenizer: {kind}")


def first_tokens(text: Column | str, count: int, kind: str = "whitespace", path: str | None = None) -> Column:
    """The first ``count`` tokens of a text."""
    if kind == "whitespace":
        return first_whitespace_tokens(text, count)
    return F.slice(tokenize(text, kind, path), 1, count)


def tokenize_lines(text: Column | str, kind: str = "whitespace", path: str | None = None) -> Column:
    """Tokens of every line of a text."""
    if kind == "subword":
        return subword_lines(text, path)
    return F.transform(F.split(text, "\n"), lambda line: tokenize(line, kind))
