"""The pipeline's stages one by one, and the queries' shapes."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from capstan.llm import bpe, queries
from tests.llm.fixtures import awkward, in_order, table, texts_of
from tests.llm.test_codec import RANKS, check_pieces
from tests.llm.test_dedup import lines_left
from tests.llm.test_pii import spans
from tests.llm.test_repeats import bytes_left, words_left

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], FOLDER).write.parquet(f"{tmp_path}/{number}")
        seen.append(spark.read.parquet(f"{tmp_path}/{number}"))
    good, fewer, different, clean, pieces = (f.collect() for f in seen[1:])
    assert all(f.columns == columns for f in seen[1:5])
    assert 0 < len(good) < docs.count()
    texts = [(r.doc_id, r.text) for r in good]
    # Each line once (small texts: the brute force is quadratic).
    short = [(i, t) for i, t in texts if t and len(t) < 4000]
    made = corpus_pipeline.first_lines(spark, spark.createDataFrame(short, "doc_id long, text string"), FOLDER)
    assert in_order(made, "doc_id", "text") == [(i, t) for i, _, _, t in lines_left(short, every=True)[0]]
    assert {r.doc_id for r in fewer} == {r.doc_id for r in good}
    assert all(r.n_chars == len(r.text) for r in fewer)
    assert len({r.doc_id for r in different}) == len(different) < len(fewer)
    assert not any("@example" in r.text for r in clean)
    check_pieces(pieces, [(r.doc_id, r.text) for r in clean])


def test_run_is_the_stages(spark):
    first = corpus_pipeline.run(spark, FOLDER)
    assert first.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert first.count() > 0


def test_contract_columns(spark):
    wanted = {
        "op1_kmeans_tree": ["query_id", "rank", "vec_id", "score"],
        "op2_deep_shallow": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op3_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op4_simhash": ["doc_id", "fingerprint", "component_id"],
        "op5_disclosure": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op7_weighted_sampling": [
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        ],
        "op9_debruijn": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op11_gnat_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
        "op12_son_phrases": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
        "op13_license_scan": [
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive",
        ],
    }
    for name, columns in wanted.items():
        made = queries.QUERIES[name](spark, FOLDER)
        assert made.columns == columns
    made = queries.QUERIES["op2_deep_shallow"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in made:
        raw = texts[r.doc_id].encode()
        assert r.n_bytes == len(raw) and (r.n_removed or r.kept_sha256 == hashlib.sha256(raw).hexdigest())


def test_digests_are_those_of_the_whole_results(spark, tmp_path):
    """The registered queries over hard rows, their digest columns against brute force."""
    rows = awkward()
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")

    def digests(name, *columns):
        return in_order(queries.QUERIES[name](spark, str(tmp_path)).where("doc_id IS NOT NULL"), *columns)

    def sha(data):
        return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()

    found = digests("op2_deep_shallow", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted((i, n, n - len(kept), spans, sha(kept)) for i, n, spans, kept in bytes_left(rows, 400))
    found = digests("op9_debruijn", "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted((i, n, gone, sha(kept)) for i, n, gone, kept in words_left(rows, 50))
    found = digests("op8_fuzzy_lines", "doc_id", "n_lines", "n_removed", "kept_sha256")
    texts = [(i, t) for i, t in rows if i is not None]
    nulls = {i for i, t in texts if t is None}
    wanted = sorted((i, 0 if i in nulls else n, gone, sha(kept)) for i, n, gone, kept in lines_left(texts, every=True)[0])
    assert [f for f in found if f[0] not in nulls] == [w for w in wanted if w[0] not in nulls]
    found = digests("op5_disclosure", "doc_id", "base_sha256")
    listed = [(i, ",".join(f"{k}:{s}:{e}" for k, s, e in spans(t))) for i, t in texts_of(rows)]
    assert found == sorted((i, sha(text)) for i, text in listed)
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(RANKS))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = digests("op3_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    ids = [(i, library.encode_ordinary(t), t) for i, t in texts_of(rows)]
    assert found == sorted((i, len(x), sha(np.array(x, "<u4").tobytes()), sha(t)) for i, x, t in ids)


def test_stages_take_awkward_documents(spark, tmp_path):
    """Null and empty texts, null and repeated ids, clashing columns, no rows at all."""
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (6, 1, 0), (8, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for number, rows in enumerate((awkward(), [], [(None, None)])):
        docs = table(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
        columns = docs.columns
        for step, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, str(tmp_path))
            assert made.columns == columns or step == len(corpus_pipeline.STAGES) - 1
            made.write.parquet(f"{tmp_path}/{number}-{step}")
            docs = spark.read.parquet(f"{tmp_path}/{number}-{step}")
        assert number or docs.count() > 0
