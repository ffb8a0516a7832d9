"""Byte-level BPE and packing against the libraries."""

import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from capstan.llm import bpe, packing, words
from tests.llm.fixtures import awkward, in_order, table, texts_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@given(text=st.text(max_size=60) | st.text(alphabet="ab'st \t\n  é1,.", max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_librarys(library, codec, text):
    text = text.encode("utf-8", "ignore").decode()
    texts = [text, "", "a", text + " b", "b " + text]
    for ids, one in zip(codec.encode(pa.array(texts)), texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(one)
        assert codec.decode(ids) == one.encode()


def test_the_model_is_read_back(codec):
    tokens = bpe.read_ranks(RANKS)
    model = sentencepiece.SentencePieceProcessor(model_proto=bpe.serialise_model(tokens))
    assert model.get_piece_size() == len(tokens) + 1 and model.unk_id() == len(tokens)
    assert model.id_to_piece(300) == bpe.mapped(tokens[300]) and model.get_score(300) == -300


def test_documents(spark, library):
    rows = awkward()
    made = bpe.encode_documents(table(spark, rows), RANKS, public_tokenizers.PATTERN)
    wanted = sorted(
        (i, np.array(library.encode_ordinary(t), "<u4").tobytes(), t.encode()) for i, t in texts_of(rows)
    )
    assert sorted((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in made.collect()) == wanted
    digests = bpe.encoding_digests(table(spark, rows), RANKS, public_tokenizers.PATTERN)
    assert in_order(digests, "doc_id", "ids_sha256", "n_tokens") == sorted(
        (i, hashlib.sha256(ids).hexdigest(), len(ids) // 4) for i, ids, _ in wanted
    )
    assert bpe.encode_documents(table(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_ranks_with_a_gap_are_refused(tmp_path):
    (tmp_path / "gap").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "gap"))


@given(text=st.text(max_size=60) | st.text(alphabet="ab'st \t\n é1,.", max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_have_the_tokenizer_files_ids(text):
    text = text.encode("utf-8", "ignore").decode()
    tokenizer = Tokenizer.from_file(FILE)
    texts = [text, "", "a", text + " b", "b " + text]
    assert [i.tolist() for i in WORDS.encode(pa.array(texts))] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


TOKENIZER = Tokenizer.from_file(FILE)
WORDS = packing.Words(packing.read_vocabulary(FILE), packing.read_special(FILE))


def check_pieces(pieces, rows, window=1024):
    """Every id in one piece, sequences gapless and full unless their size is a power of two."""
    tokenizer = Tokenizer.from_file(FILE)
    wanted = sorted(
        (i, tuple(tokenizer.encode(t, add_special_tokens=False).ids) + (0,)) for i, t in texts_of(rows)
    )
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    sums = defaultdict(list)
    for i, ids in wanted:
        sums[i].append(ids)
    for i, several in sums.items():
        assert sum(p.length for p in by_document[i]) == sum(map(len, several))
        for p in by_document[i]:
            assert any(
                p.doc_tokens == len(ids)
                and p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
                for ids in several
            )
    assert set(by_document) == set(sums)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == window or at & (at - 1) == 0 and at < window


def test_packing(spark):
    rows = awkward()
    check_pieces(packing.pack_documents(table(spark, rows), FILE).collect(), rows)
    assert packing.pack_documents(table(spark, []), FILE).count() == 0


def test_packing_some_bytes_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(words, "BYTES_AT_ONCE", 700)
    rows = awkward()
    check_pieces(packing.pack_documents(table(spark, rows), FILE).collect(), rows)


def test_packing_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 3)
    rows = awkward()
    check_pieces(packing.pack_documents(table(spark, rows), FILE, window=128).collect(), rows, 128)


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(5)
    units = [rng.integers(0, 60, rng.integers(5, 40)).astype(np.uint32) for _ in range(50)]
    rows = [{"term": t, "n": sum(t in u for u in units)} for t in range(60)]
    statistics = packing.Statistics([*rows, {"term": -1, "n": 50}, {"term": -2, "n": sum(map(len, units))}])
    index = packing.Shard(units, statistics)

    def weight(term, unit):
        tf = (unit == term).sum()
        n = sum(term in u for u in units)
        idf = np.log(1 + (50 - n + 0.5) / (n + 0.5))
        mean = sum(map(len, units)) / 50
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(unit) / mean))

    seed = units[7]
    terms = sorted(set(seed.tolist()), key=lambda t: (-weight(t, seed), t))[: packing.QUERY_TERMS]
    scores = np.array([sum(weight(t, u) for t in terms) for u in units])
    unused = np.ones(50, bool)
    unused[7] = unused[11] = False
    found = index.neighbours(7, unused)
    assert 11 not in found and 7 not in found
    assert np.allclose(scores[found], sorted(scores[[i for i in range(50) if unused[i] and scores[i] > 0]])[::-1])


SPECIAL_TEXTS = ["{}", "x {} y", "{}{}", " {}\n{} z", "<|endoftext", "a{}'s", "{} b  c"]


def test_special_tokens_are_the_librarys():
    with open(FILE) as file:
        special = json.load(file)["added_tokens"][0]["content"]
    texts = [t.replace("{}", special) for t in SPECIAL_TEXTS]
    wanted = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in WORDS.encode(pa.array(texts))] == wanted and any(50256 in i for i in wanted)


def test_packing_special_tokens(spark):
    rows = [(i, t.replace("{}", "<|endoftext|>")) for i, t in enumerate(SPECIAL_TEXTS)]
    check_pieces(packing.pack_documents(table(spark, rows), FILE).collect(), rows)


CODE_POINTS = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
AT_ONCE = 4096


@pytest.mark.parametrize("around", ["{}'m", "'{}", "a{}1", " {} ", "{}\n{}"])
def test_every_code_point_splits_as_in_the_libraries(library, codec, around):
    """Many in a text: a text's ids tell how it was split."""
    each = [around.replace("{}", c) for c in CODE_POINTS]
    texts = ["\n".join(each[i : i + AT_ONCE]) for i in range(0, len(each), AT_ONCE)]
    made = codec.encode(pa.array(texts))
    assert [np.frombuffer(i, "<u4").tolist() for i in made] == library.encode_ordinary_batch(texts)
    wanted = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in WORDS.encode(pa.array(texts))] == wanted
