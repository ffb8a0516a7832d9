"""The registered queries of this subpackage: thin digests of its operators' results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.llm import ann, bpe, debruijn, licences, lines, negatives, packing, phrases, pii, quality, simhash, suffixes, weighted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def _listed(spans: Column) -> Column:
    def one(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def op5_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    terms = F.transform("terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"], t["end"]))
    base = F.transform("base", lambda b: F.struct(b["kind"], b["start"], b["end"]))
    kinds = F.transform("base", lambda b: b["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    digest = F.sha2(F.encode(_listed(base), "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, _listed(F.concat(base, terms)).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"edited_sha256": F.sha2(F.encode("edited", "UTF-8"), 256)}
    made = weighted.edited_fingerprints(table(spark, sf_dir, "documents"), digest)
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        weighted.as_text(F.col("entries")).alias("fingerprint"),
        weighted.as_text(F.col("edited_entries")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lines.without_repeats(table(spark, sf_dir, "documents"), every=True)
    return made.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op9_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = debruijn.without_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return made.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = quality.grade_of_labels(table(spark, sf_dir, "labels"))
    return quality.quality(table(spark, sf_dir, "documents"), ratings)


def op11_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the labels is moved on by one, so that near rows of other labels exist."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), support=100, top=2000)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    places = F.transform("base", lambda b: b["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        "permissive",
    )


QUERIES = {
    "op1_kmeans_tree": op1_kmeans_tree,
    "op2_deep_shallow": op2_deep_shallow,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_simhash": op4_simhash,
    "op5_disclosure": op5_disclosure,
    "op6_packing": op6_packing,
    "op7_weighted_sampling": op7_weighted_sampling,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_debruijn": op9_debruijn,
    "op10_ordinal_quality": op10_ordinal_quality,
    "op11_gnat_negatives": op11_gnat_negatives,
    "op12_son_phrases": op12_son_phrases,
    "op13_license_scan": op13_license_scan,
}
ORACLES = {
    "op11_gnat_negatives": """
WITH usable AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER w AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
""",
    "op12_son_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM listed GROUP BY lang
), grams AS (
  SELECT lang, words[i : i + k - 1] AS phrase
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM listed, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k)
), frequent AS (
  SELECT lang, phrase, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, f AS a, unnest(range(1, len(phrase))) AS k FROM frequent
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, k,
         CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN frequent x ON x.lang = c.lang AND x.phrase = c.phrase[1 : k]
  JOIN frequent y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1 :]
), weakest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT w.lang, w.phrase FROM weakest w
  JOIN (SELECT lang, f, unnest(list_concat([phrase[1 : i] for i in range(2, len(phrase))],
                                           [phrase[i :] for i in range(2, len(phrase))],
                                           [phrase[2 : i] for i in range(3, len(phrase))],
                                           [phrase[3 : 4]])) AS part, len(phrase) AS size
        FROM frequent WHERE len(phrase) > 2) longer
    ON longer.lang = w.lang AND longer.part = w.phrase AND longer.size > len(w.phrase) AND 100 * longer.f >= 100 * w.a
), kept AS (
  SELECT * EXCLUDE (phrase), array_to_string(phrase, ' ') AS phrase FROM weakest w
  WHERE NOT EXISTS (FROM inside i WHERE i.lang = w.lang AND i.phrase = w.phrase)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept
QUALIFY rank <= 2000
""",
}
