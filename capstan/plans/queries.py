"""Registered queries: one callable (spark, sf_dir) -> DataFrame each."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.functions import labels as L
from capstan.functions import text as X
from capstan.functions.pixels import channel_means
from capstan.operators import bleu as B
from capstan.operators import buffered as BU
from capstan.operators import corpus_metric as CM
from capstan.operators import fitting as FI
from capstan.operators import generation as G
from capstan.operators import loss as LO
from capstan.operators import meteor as M
from capstan.operators import ngrams as N
from capstan.operators import quantiles as Q
from capstan.operators import report as R
from capstan.operators import rouge as RG
from capstan.operators import sampling as S
from capstan.operators import scoring as SC
from capstan.operators import vocabulary as V
from capstan.operators.bootstrap import bootstrap_mean
from capstan.plans import jobs, views
from capstan.plans.user_metrics import CorpusBleu
from capstan.schemas import LENGTHS, PREDICTIONS, RAW_COLUMNS
from capstan.session import scratch_path, stored
from capstan.settings import EvaluateSettings, PredictSettings, PreprocessSettings, Settings, TrainDataSettings
from capstan.sources import pictures as P
from capstan.sources import sinks
from capstan.sources.caption_source import load_captions, stream_loaded_captions
from capstan.streaming import jobs as ST
from capstan.streaming import state as SS

LENGTH = 64
SEED = 42
HEAD = 100
BATCH = 32
LOG_BATCH = 4
SOURCE_BYTES = 1 << 20
EVAL_STEPS = 5
# Ids of the rows of one step lie below this.
STEP_IDS = 1 << 32


def joined(column: Column | str) -> Column:
    """An array as comma-separated text, for comparison across engines."""
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(column.cast("array<string>"), ",")


def r6(column: Column | str, name: str) -> Column:
    return F.round(column, 6).alias(name)


# Captions, lengths, samples


def caption_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    captions = views.captions_of(views.table(spark, sf_dir, "documents"))
    rows = captions.where(F.col("split") == "de")
    return rows.withColumnRenamed("image_id", "id").drop(
        *[c for c in RAW_COLUMNS if c not in ("caption_id", "caption")], "lang", "source"
    )


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.preprocess(views.captions(spark, sf_dir), PreprocessSettings(num_train_data=0))


def caption_lengths(spark, sf_dir):
    return _lengths(spark, sf_dir)


def caption_lengths_head(spark, sf_dir):
    return jobs.preprocess(views.captions(spark, sf_dir), PreprocessSettings(num_train_data=HEAD))


def length_profile(spark, sf_dir):
    profile = jobs.length_profile(_lengths(spark, sf_dir), LENGTH)
    return profile.select(
        "n", "min_length", "max_length", *[r6(c, c) for c in ("avg_length", "p50", "p95", "p99", "share_over")]
    )


def _profile_checked(lengths: DataFrame, state: DataFrame) -> DataFrame:
    profile = Q.finish_lengths(state)
    off = Q.rank_errors(lengths, profile)
    within = [(F.col(f"off_p{q}") <= Q.RANK_ERROR).alias(f"p{q}_within") for q in (50, 95, 99)]
    exact = profile.select("n", "min_length", "max_length", r6("avg_length", "avg_length"), r6("share_over", "share_over"))
    return exact.crossJoin(off.select(*within))


def length_sketch(spark, sf_dir):
    """The profile from sketches of the languages, stored and merged; whether percentiles are within their bound."""
    captions = views.captions(spark, sf_dir).select("caption_id", "lang")
    lengths = stored(_lengths(spark, sf_dir).join(captions, "caption_id"), "lengths")
    states = stored(Q.length_state(lengths, LENGTH, ["lang"]), "length-states")
    return _profile_checked(lengths, Q.merge_length_states(states))


def lengths_csv(spark, sf_dir):
    settings = PreprocessSettings(num_train_data=0, output_dir=scratch_path(spark, "lengths"))
    written = jobs.run_preprocess(views.captions(spark, sf_dir), settings)
    return sinks.read_csv(spark, written.path, LENGTHS).withColumn("rows_written", F.lit(written.rows).cast("long"))


def token_kinds(spark, sf_dir):
    captions = views.captions(spark, sf_dir)
    kinds = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), X.tokenize("caption", k).alias("tokens"))
            for k in ("whitespace", "word", "char")
        ]
    )
    rows = captions.select("lang", F.inline(kinds))
    # The tokens themselves, as a sum of hashes.
    mark = F.conv(F.substring(F.md5(joined("tokens")), 1, 8), 16, 10).cast("long")
    return rows.groupBy("lang", "kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("tokens")).alias("tokens"),
        F.max(F.size("tokens")).alias("most"),
        F.sum(mark).alias("contents"),
    )


def subword_lengths(spark, sf_dir):
    from public_tokenizers import path

    file = path("byte_bpe_50k.json")
    captions = views.captions(spark, sf_dir).select("caption_id", "caption")
    ids = X.subword_ids("caption", file)
    return captions.withColumn("ids", ids).select(
        "caption_id",
        F.size("ids").alias("length"),
        # This vocabulary has no PAD: its end token fills nothing, -100 does.
        joined(L.make_labels(F.col("ids"), LENGTH, None)).alias("labels"),
        F.size(F.filter(L.unmask(L.make_labels(F.col("ids"), LENGTH, None), None, 50256), lambda x: x != 50256)).alias("kept"),
    )


def shuffle_head(spark, sf_dir):
    captions = views.captions(spark, sf_dir).select("caption_id", "image_id", "lang")
    keyed = S.shuffled_head(captions, HEAD, SEED, "caption_id")
    return keyed.withColumn("shuffle_key", S.shuffle_key(SEED, "caption_id"))


def shuffle_rank(spark, sf_dir):
    """The whole table in seeded order, numbered."""
    captions = views.captions(spark, sf_dir).select("caption_id", "image_id")
    keyed = captions.withColumn("shuffle_key", S.shuffle_key(SEED, "caption_id"))
    return S.global_rank(keyed, "shuffle_key", "caption_id", name="position").drop("shuffle_key")


def buffer_shuffle(spark, sf_dir):
    """Rows shuffled by a buffer in each split: whether each stays within the buffer's reach of its place."""
    captions = views.captions(spark, sf_dir).select("caption_id")
    placed = captions.withColumn("before", F.monotonically_increasing_id())
    shuffled = BU.buffered_shuffle(placed, TrainDataSettings().shuffle_buffer, SEED)
    same_split = F.shiftright("before", 33) == F.col("split_id")
    start = F.col("before").bitwiseAND(F.lit((1 << 33) - 1))
    early = start - F.col("position") < TrainDataSettings().shuffle_buffer
    return shuffled.select("caption_id", (same_split & early).alias("in_reach"))


def train_buffer(spark, sf_dir):
    """Training rows by the buffered shuffle, ordered within splits."""
    captions = views.captions(spark, sf_dir)
    settings = TrainDataSettings(shuffle_order="buffer")
    data = jobs.prepare_train(
        captions.where(F.col("split") == "en"), captions.where(F.col("split") != "en"), _vocabulary(spark, sf_dir), settings
    )
    places = Window.partitionBy("split_id").orderBy("position")
    numbered = data.train.withColumn("gapless", F.col("position") == F.row_number().over(places) - 1)
    return numbered.select("caption_id", "id", joined("labels").alias("labels"), "gapless")


def batch_assign(spark, sf_dir):
    captions = views.captions(spark, sf_dir).select("caption_id")
    return S.batches(captions, BATCH, "caption_id")


def train_data(spark, sf_dir):
    """Training rows in seeded order with labels, next to the step count."""
    captions = views.captions(spark, sf_dir)
    vocabulary = _vocabulary(spark, sf_dir)
    data = jobs.prepare_train(
        captions.where(F.col("split") == "en"),
        captions.where(F.col("split") != "en"),
        vocabulary,
        TrainDataSettings(),
    )
    rows = data.train.select(F.lit("train").alias("part"), "caption_id", "id", "labels").unionByName(
        data.valid.select(F.lit("valid").alias("part"), "caption_id", "id", "labels")
    )
    return rows.withColumn("max_steps", data.max_steps.scalar()).withColumn("labels", joined("labels"))


# Vocabulary and labels


def _caption_words(spark, sf_dir):
    captions = views.captions(spark, sf_dir)
    return captions.select("caption_id", X.whitespace_tokens(F.lower("caption")).alias("tokens"))


def vocab_build(spark, sf_dir):
    return V.build_vocabulary(_caption_words(spark, sf_dir), "tokens")


def _vocabulary(spark, sf_dir):
    """The vocabulary as a table: its files hold id ranges, so lookups skip most."""
    return stored(vocab_build(spark, sf_dir), "vocabulary")


def vocab_encode(spark, sf_dir):
    ids = V.encode(_caption_words(spark, sf_dir), "caption_id", "tokens", _vocabulary(spark, sf_dir))
    return ids.select("caption_id", F.size("ids").alias("n"), F.md5(joined("ids")).alias("ids_md5"))


def vocab_decode(spark, sf_dir):
    vocabulary = _vocabulary(spark, sf_dir)
    ids = V.encode(_caption_words(spark, sf_dir), "caption_id", "tokens", vocabulary)
    marked = ids.withColumn("ids", F.concat(F.array(F.lit(V.CLS)), "ids", F.array(F.lit(V.SEP), F.lit(V.PAD))))
    return V.decode(marked, "caption_id", "ids", vocabulary)


def _labels(spark, sf_dir, pad_id):
    settings = Settings()
    return jobs.caption_labels(views.captions(spark, sf_dir), _vocabulary(spark, sf_dir), settings, pad_id)


def labels_pad_branch(spark, sf_dir):
    labels = _labels(spark, sf_dir, V.PAD)
    kept = L.token_count("labels", L.IGNORED).alias("kept")
    return labels.select("caption_id", joined("labels").alias("labels"), kept)


def labels_nopad_branch(spark, sf_dir):
    labels = _labels(spark, sf_dir, None)
    return labels.select("caption_id", joined("labels").alias("labels"))


def labels_unmask(spark, sf_dir):
    """Both replacements of the ignored label, and the text of the labels."""
    vocabulary = _vocabulary(spark, sf_dir)
    labels = jobs.caption_labels(views.captions(spark, sf_dir), vocabulary, Settings())
    unmasked = labels.select(
        "caption_id",
        L.unmask("labels", V.PAD).alias("ids"),
        joined(L.unmask("labels", None, V.SEP)).alias("with_end"),
    )
    text = V.decode(unmasked.select("caption_id", "ids"), "caption_id", "ids", vocabulary, name="labels")
    return unmasked.withColumn("ids", joined("ids")).join(text, "caption_id")


def _caption_files(spark, sf_dir) -> str:
    """The captions as JSON lines, a folder for each split of one configuration."""
    folder = scratch_path(spark, "caption-files")
    captions = views.captions(spark, sf_dir).drop("lang", "source")
    captions.write.partitionBy("split").json(f"{folder}/2014")
    return folder


def source_scan(spark, sf_dir):
    """One split of caption files through the data source, which lists and reads no other."""
    rows = load_captions(spark, _caption_files(spark, sf_dir), partition_bytes=SOURCE_BYTES)
    return rows.where(F.col("split") == "de").select("image_id", "image_path", "caption_id", "caption", "height")


def source_stream(spark, sf_dir):
    """All splits of the caption files, as a stream of their lines; two columns are read."""
    folder = scratch_path(spark, "source-stream")
    columns = ["caption_id", "caption"]
    files = _caption_files(spark, sf_dir)
    stream = stream_loaded_captions(spark, files, columns=columns, partition_bytes=SOURCE_BYTES)
    ST.stream_rows(stream, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    return rows.select("caption_id", F.size(X.whitespace_tokens("caption")).alias("length"))


# Pairs, grams, BLEU


def pairs_join(spark, sf_dir):
    return views.pairs_conv(spark, sf_dir)


def union_predictions(spark, sf_dir):
    pairs = views.pairs_drop(spark, sf_dir).select("id", "lang", F.size("prediction").alias("n"))
    first = pairs.where(F.col("lang") == "en")
    return first.unionByName(pairs.where(F.col("lang") != "en")).unionByName(first)


def ngram_counts(spark, sf_dir):
    counts = N.gram_counts(views.pairs_drop(spark, sf_dir), "id", "reference", listed=True)
    times = F.col("grams.count")
    return counts.select(
        "id",
        "n",
        F.size("grams").cast("long").alias("distinct_grams"),
        F.aggregate(times, F.lit(0).cast("long"), lambda total, count: total + count).alias("grams"),
        F.array_max(times).alias("most"),
        F.array_min("grams.gram").alias("first_gram"),
    )


def ngram_clipped(spark, sf_dir):
    return N.overlap(views.pairs_drop(spark, sf_dir)).where(F.col("n") > 0)


def _conv_tokens(spark, sf_dir):
    return R.tokenized(views.pairs_conv(spark, sf_dir))


def _bleu_columns(frame: DataFrame, groups: list[str] = ()) -> DataFrame:
    return frame.select(
        *groups,
        r6("score", "score"),
        joined("counts").alias("counts"),
        joined("totals").alias("totals"),
        *[r6(F.col("precisions")[i], f"precision_{i + 1}") for i in range(4)],
        r6("bp", "bp"),
        "sys_len",
        "ref_len",
    )


def bleu_corpus(spark, sf_dir):
    return _bleu_columns(B.bleu(views.pairs_drop(spark, sf_dir)))


def bleu_corpus_conv(spark, sf_dir):
    return _bleu_columns(B.bleu(_conv_tokens(spark, sf_dir)))


def bleu_by_lang(spark, sf_dir):
    return _bleu_columns(B.bleu(views.pairs_drop(spark, sf_dir), ["lang"]), ["lang"])


def bleu_ratio_form(spark, sf_dir):
    ratio = B.ratio_form(B.bleu(views.pairs_drop(spark, sf_dir), ["source"]), ["source"])
    return ratio.select(
        "source",
        *[r6(c, c) for c in ("bleu", "brevity_penalty", "length_ratio")],
        *[r6(F.col("precisions")[i], f"precision_{i + 1}") for i in range(4)],
        "translation_length",
        "reference_length",
    )


def bleu_state_merge(spark, sf_dir):
    """States of the sources, stored and read back, then merged per language."""
    path = scratch_path(spark, "states")
    states = B.bleu_state(views.pairs_drop(spark, sf_dir), ["lang", "source"])
    states.write.parquet(path)
    merged = B.merge_states(spark.read.parquet(path), ["lang"])
    return _bleu_columns(B.finish_bleu(merged, ["lang"]), ["lang"])


# ROUGE, METEOR, report


def _rouge_n(pairs, n):
    return RG.mean_scores(RG.rouge_n_rows(pairs), [f"rouge{n}"]).select(r6(f"rouge{n}", f"rouge{n}"))


def rouge1(spark, sf_dir):
    return _rouge_n(views.pairs_drop(spark, sf_dir), 1)


def rouge2(spark, sf_dir):
    return _rouge_n(views.pairs_drop(spark, sf_dir), 2)


def rouge_rows_conv(spark, sf_dir):
    rows = RG.rouge_n_rows(_conv_tokens(spark, sf_dir))
    return rows.select("id", r6("rouge1", "rouge1"), r6("rouge2", "rouge2"))


def rouge_l(spark, sf_dir):
    rows = views.pairs_drop(spark, sf_dir).select("lang", RG.rouge_l_column().alias("rougeL"))
    return RG.mean_scores(rows, ["rougeL"], ["lang"]).select("lang", r6("rougeL", "rougeL"))


def rouge_l_rows_conv(spark, sf_dir):
    return _conv_tokens(spark, sf_dir).select("id", r6(RG.rouge_l_column(), "rougeL"))


def rouge_lsum(spark, sf_dir):
    return _conv_tokens(spark, sf_dir).select("id", r6(RG.rouge_lsum_column(), "rougeLsum"))


def rouge_bootstrap(spark, sf_dir):
    rows = RG.rouge_n_rows(views.pairs_drop(spark, sf_dir))
    interval = bootstrap_mean(rows, "id", "rouge1", seed=SEED)
    return interval.select(*[r6(c, c) for c in ("low", "mid", "high", "mean")])


def meteor_exact(spark, sf_dir):
    """Exact stage only, over all texts."""
    rows = M.meteor_rows(views.pairs_drop(spark, sf_dir), stems=False)
    return rows.select("id", "matches", "chunks", r6("meteor", "meteor"))


def meteor(spark, sf_dir):
    rows = M.meteor_rows(_conv_tokens(spark, sf_dir))
    return rows.select("id", "matches", "chunks", r6("meteor", "meteor"))


def user_metric(spark, sf_dir):
    """Corpus BLEU as a user writes it, from states of batches that merge in a tree."""
    sides = [F.array_join(side, " ").alias(side) for side in ("prediction", "reference")]
    pairs = views.pairs_drop(spark, sf_dir).select("id", "lang", *sides)
    scores = CM.corpus_metric(pairs, CorpusBleu, ["lang"], "score", fan_in=4)
    return scores.select("lang", r6("score", "score"))


def metrics_report(spark, sf_dir):
    """Native metrics of all pairs, one record per language."""
    pairs = views.pairs_drop(spark, sf_dir)
    state = R.metric_state(pairs, ("bleu", "rouge1", "rouge2"), ["lang"])
    report = R.finish_metrics(state, ["lang"])
    return report.select("lang", r6("score", "score"), r6("rouge1", "rouge1"), r6("rouge2", "rouge2"), "n_pairs")


def metrics_report_full(spark, sf_dir):
    """Every metric of the conversation pairs as one record."""
    return R.evaluate(views.pairs_conv(spark, sf_dir))


def metrics_report_subword(spark, sf_dir):
    """BLEU over words, ROUGE over sub-words, METEOR over words."""
    from public_tokenizers import path

    tokenizers = {"bleu": "word", "rouge": "subword", "meteor": "word"}
    return R.evaluate(views.pairs_conv(spark, sf_dir), tokenizers=tokenizers, path=path("word_bpe_49k.json"))


# Losses


def ce_row_loss(spark, sf_dir):
    rows = LO.row_losses(views.logits(spark, sf_dir))
    return rows.select("id", r6("loss", "loss"), "tokens")


def ce_row_loss_arrays(spark, sf_dir):
    """The same from one row of arrays per id."""
    entry = F.struct("pos", "label", "logits")
    rows = views.logits(spark, sf_dir).groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    arrays = rows.select(
        "id",
        F.transform("e", lambda e: e["label"]).alias("labels"),
        F.transform("e", lambda e: e["logits"]).alias("logits"),
    )
    return LO.row_losses(LO.flatten_positions(arrays)).select("id", r6("loss", "loss"), "tokens")


def split_vocabulary_loss(spark, sf_dir):
    """Row losses from logits that lie in four rows a position, a part of the vocabulary each."""
    parts = F.posexplode(F.array(*[F.slice("logits", 16 * k + 1, 16) for k in range(4)])).alias("part", "logits")
    rows = views.logits(spark, sf_dir).select("id", "pos", "label", parts)
    losses = LO.split_row_losses(rows.withColumn("first", F.col("part") * 16))
    return losses.select("id", r6("loss", "loss"), "tokens")


def eval_loss_batched(spark, sf_dir):
    loss = LO.evaluation_loss(views.logits(spark, sf_dir), BATCH)
    return loss.select(r6("eval_loss", "eval_loss"), "n_rows", "n_tokens")


def eval_loss_token(spark, sf_dir):
    loss = LO.token_mean_loss(views.logits(spark, sf_dir))
    return loss.select(r6("token_loss", "token_loss"), "n_tokens")


def _eval_log(spark, sf_dir):
    losses = LO.batch_losses(views.logits(spark, sf_dir), LOG_BATCH)
    return losses.select(F.col("batch").alias("step"), F.round("eval_loss", 6).alias("eval_loss"))


def eval_schedule(spark, sf_dir):
    rows = views.logits(spark, sf_dir).select("id").distinct()
    steps = S.max_steps(rows, epochs=1, batch_size=LOG_BATCH)
    return S.evaluation_steps(_eval_log(spark, sf_dir), steps, EVAL_STEPS)


def best_checkpoint(spark, sf_dir):
    return S.best_step(_eval_log(spark, sf_dir))


def runs_table(spark, sf_dir):
    """Runs of two seeds in one table, with settings and rates of a fixed two seconds; one is committed twice."""
    path = scratch_path(spark, "runs")
    losses = LO.token_mean_loss(views.logits(spark, sf_dir))
    for run, seed in (("first", 1), ("second", 2), ("first", 1)):
        settings = EvaluateSettings(random_seed=seed)
        record = sinks.run_record(losses, settings, run, 0, 2.0, 64, 2)
        sinks.commit_run(record, path)
    runs = sinks.read_runs(spark, path)
    return runs.select(
        "run_id",
        "step",
        F.col("settings.random_seed").alias("random_seed"),
        F.col("settings.max_sequence_length").alias("max_sequence_length"),
        r6("token_loss", "token_loss"),
        "n_tokens",
        "eval_samples_per_second",
        "eval_steps_per_second",
    )


def training_log(spark, sf_dir):
    """Evaluations of a run every four steps, as its logits sharpen; the run is logged again after a stop."""
    logits = views.logits(spark, sf_dir)
    steps = logits.select("*", F.explode(F.sequence(F.lit(0), F.lit(14))).alias("step"))
    sharp = F.transform("logits", lambda x: x.cast("double") * F.col("step") / 10)
    at_step = steps.select((F.col("step") * STEP_IDS + F.col("id")).alias("id"), "pos", "label", sharp.alias("logits"))
    losses = LO.row_losses(at_step)
    losses = losses.select(F.expr(f"id div {STEP_IDS}").alias("step"), (F.col("id") % STEP_IDS).alias("id"), "loss", "tokens")
    losses = stored(losses, "losses")
    settings = TrainDataSettings(
        output_dir=scratch_path(spark, "training"), eval_steps=4, num_train_data=13, train_batch_size=1, valid_batch_size=LOG_BATCH
    )
    jobs.run_training_log(losses.where(F.col("step") <= 8), settings, "only")
    best = jobs.run_training_log(losses, settings, "only")
    runs = sinks.read_runs(spark, f"{settings.output_dir}/runs")
    kept = best.select("run_id", F.col("step").alias("kept_step"))
    rows = runs.join(kept, "run_id")
    return rows.select(
        "run_id", "step", r6("eval_loss", "eval_loss"), "n_rows", "n_tokens", (F.col("step") == F.col("kept_step")).alias("kept")
    )


# Generation and prediction


def _sequences(spark, sf_dir):
    return jobs.caption_sequences(views.captions(spark, sf_dir))


def next_token_table(spark, sf_dir):
    """All successors of each token over the whole corpus, likeliest first."""
    return G.next_tokens(G.bigrams(_sequences(spark, sf_dir), [], "seq"), [])


def next_token_by_picture(spark, sf_dir):
    return G.next_tokens(G.bigrams(_sequences(spark, sf_dir), ["image_id"], "seq"), ["image_id"])


def _beams(spark, sf_dir, max_new_tokens):
    settings = EvaluateSettings(max_new_tokens=max_new_tokens)
    best = jobs.generate(views.captions(spark, sf_dir), settings)
    return best.select("image_id", "predicted", r6("score", "score"))


def beam_step1(spark, sf_dir):
    return _beams(spark, sf_dir, 1)


def beam_search(spark, sf_dir):
    return _beams(spark, sf_dir, G.MAX_NEW_TOKENS)


def _predictions(spark, sf_dir):
    return jobs.predict(views.captions(spark, sf_dir), _vocabulary(spark, sf_dir), PredictSettings())


def predictions_table(spark, sf_dir):
    """The predictions CSV, read back."""
    path = scratch_path(spark, "predictions")
    sinks.write_csv(_predictions(spark, sf_dir).select(*PREDICTIONS.fieldNames()), path)
    rows = sinks.read_csv(spark, path, PREDICTIONS)
    return rows.withColumn("loss", F.round("loss", 6))


def evaluate_job(spark, sf_dir):
    """Generation, decoding, metrics and the runs table in one job, without its wall time."""
    settings = EvaluateSettings(output_dir=scratch_path(spark, "evaluate"))
    jobs.run_evaluate(_predictions(spark, sf_dir), settings, metrics=("bleu", "rouge1", "rouge2"))
    runs = sinks.read_runs(spark, f"{settings.output_dir}/runs")
    values = [r6(c, c) for c in ("score", "rouge1", "rouge2", "eval_loss")]
    return runs.select("step", F.col("settings.num_beams").alias("num_beams"), *values, "n_tokens", "n_pairs")


def beam_search_shared(spark, sf_dir):
    """One table of the whole corpus, asked for each caption from its first two words."""
    captions = views.captions(spark, sf_dir)
    settings = EvaluateSettings(prompt_tokens=2, max_new_tokens=3)
    best = jobs.generate(captions, settings, jobs.fit_tokens(captions, settings))
    # Shares of at most six parts: nine digits of them have no halves.
    return best.select("caption_id", "predicted", F.round("score", 9).alias("score"))


def beam_no_repeat3(spark, sf_dir):
    """The search per picture that repeats no three tokens instead of no two."""
    settings = EvaluateSettings(max_new_tokens=8, no_repeat_ngram_size=3)
    best = jobs.generate(views.captions(spark, sf_dir), settings)
    return best.select("image_id", "predicted", r6("score", "score"))


def predictions_heldout(spark, sf_dir):
    """German captions scored and continued by a model of all others."""
    captions = views.captions(spark, sf_dir)
    settings = PredictSettings(prompt_tokens=1, max_new_tokens=2, num_beams=3)
    model = jobs.fit_tokens(captions.where("split <> 'de'"), settings)
    rows = jobs.predict(captions.where("split = 'de'"), _vocabulary(spark, sf_dir), settings, model)
    return rows.select("id", r6("loss", "loss"), "tokens", "predicted_labels", "labels")


def predictions_model(spark, sf_dir):
    """Captions by a fitted model of pictures: a batch predictor scores the live beams of each step."""
    captions = stored(views.label_captions(spark, sf_dir), "label-captions")
    features = stored(views.vector_features(spark, sf_dir), "features")
    tokens = captions.select("caption_id", "image_id", X.whitespace_tokens("caption").alias("tokens"))
    vocabulary = stored(V.build_vocabulary(tokens, "tokens"), "vocabulary")
    ids = V.encode(tokens, "caption_id", "tokens", vocabulary)
    framed = F.concat(F.array(F.lit(V.CLS)), "ids", F.array(F.lit(V.SEP))).alias("ids")
    rows = captions.join(ids.select("caption_id", framed), "caption_id").join(features, "image_id")
    fitted = FI.fit_captions(rows, V.FIRST_ID + vocabulary.count())
    model = jobs.PictureModel(FI.caption_model(fitted), features)
    settings = PredictSettings(num_beams=3, max_new_tokens=4)
    predictions = jobs.predict(captions, vocabulary, settings, model)
    return predictions.select("id", r6("loss", "loss"), "tokens", "predicted_labels", "labels")


def metrics_with_nulls(spark, sf_dir):
    """Metrics of pairs of which some texts are missing: these count as empty."""
    pairs = views.pairs_conv(spark, sf_dir).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.col("prediction")).alias("prediction"),
        F.when(F.col("id") % 5 != 0, F.col("reference")).alias("reference"),
    )
    own = {"longer": lambda prediction, reference: F.length(prediction) > F.length(reference)}
    report = R.evaluate(pairs, ("bleu", "rouge1", "rougeL"), scores=own)
    return report.select(*[r6(c, c) for c in ("score", "rouge1", "rougeL", "longer")], "n_pairs")


def head_many(spark, sf_dir):
    """A third of the rows in seeded order: a head of any size takes one path."""
    captions = views.captions(spark, sf_dir).select("caption_id", "lang")
    return S.head(captions, 333, "lang", "caption_id")


def _labelled_vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")


def _label_predictor(spark, sf_dir):
    return FI.linear_model(FI.fit_centres(_labelled_vectors(views.table(spark, sf_dir, "embeddings")), 64))


def batch_inference(spark, sf_dir):
    """Labels of the vectors by a predictor that was fitted, saved, and loaded by each worker."""
    rows = _labelled_vectors(views.table(spark, sf_dir, "embeddings"))
    scored = SC.score_rows(rows, _label_predictor(spark, sf_dir), 64, batch_size=BATCH)
    return scored.select("id", "label", "predicted", F.round("loss", 4).alias("loss"))


def user_batches(spark, sf_dir):
    """A user function that Spark has no counterpart for, over batches of captions: accents taken off."""

    def plain(batch: dict[str, list]) -> dict[str, list]:
        texts = [unicodedata.normalize("NFD", text or "") for text in batch["caption"]]
        marks = [sum(unicodedata.combining(c) > 0 for c in text) for text in texts]
        return {"caption_id": batch["caption_id"], "length": [len(t) - m for t, m in zip(texts, marks, strict=True)]}

    captions = views.captions(spark, sf_dir)
    return SC.map_batches(captions, plain, LENGTHS, ["caption_id", "caption"], batch_size=BATCH)


# Pictures


CHANNEL_MEANS = {"means": (T.ArrayType(T.DoubleType()), channel_means)}


def _pictured(spark, sf_dir) -> DataFrame:
    """Captions whose paths lead to picture files: those of the pictures that the table has vectors of."""
    folder = views.write_pictures(spark, sf_dir)
    captions = views.with_vectors(views.captions(spark, sf_dir), views.table(spark, sf_dir, "embeddings"))
    return captions.withColumn("image_path", P.plain_path(F.concat(F.lit(folder + "/"), "image_path")))


def train_pixels(spark, sf_dir):
    """Training rows of the job with the pixels of their picture, opened by path."""
    captions = _pictured(spark, sf_dir).where(F.col("split") == "de")
    settings = TrainDataSettings(shuffle_order="buffer")
    pixels = jobs.packed_inputs(captions, settings, CHANNEL_MEANS)
    data = jobs.prepare_train(captions, captions, _vocabulary(spark, sf_dir), settings, pixels)
    means = data.train.select("caption_id", "id", F.size("pixel_values").alias("n_values"), "means")
    return means.select("caption_id", "id", "n_values", *[F.round(F.col("means")[i], 4).alias(f"mean_{c}") for i, c in enumerate("rgb")])


def image_pixels(spark, sf_dir):
    """Pictures of the vectors: opened by the paths of captions, converted, resized, joined to captions."""
    captions = _pictured(spark, sf_dir).select("caption_id", "image_path")
    features = P.pixel_features(P.read_pictures_at(captions), measures=CHANNEL_MEANS)
    pixel = F.col("pixel_values")
    side = P.SIDE
    summary = features.select(
        "image_path",
        F.size(pixel).alias("n_values"),
        "means",
        F.round(F.get(pixel, F.lit(40 * side + 100)).cast("double"), 4).alias("red_40_100"),
        F.round(F.get(pixel, F.lit(2 * side * side + 150 * side + 7)).cast("double"), 4).alias("blue_150_7"),
    )
    return P.join_pictures(captions, summary).select(
        "caption_id",
        "n_values",
        *[F.round(F.col("means")[i], 4).alias(f"mean_{c}") for i, c in enumerate("rgb")],
        "red_40_100",
        "blue_150_7",
    )


# Streams


def _stream(spark, sf_dir, name):
    return views.stream_table(spark, sf_dir, name)


def stream_prepare(spark, sf_dir):
    folder = scratch_path(spark, "stream-prepare")
    vocabulary = _vocabulary(spark, sf_dir)
    stream = views.captions_of(_stream(spark, sf_dir, "documents"))
    query = ST.stream_batches(
        stream,
        lambda batch: jobs.caption_labels(batch, vocabulary, Settings()),
        f"{folder}/labels",
        f"{folder}/checkpoint",
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/labels").drop("batch_id")
    return rows.withColumn("labels", joined("labels"))


def stream_predict(spark, sf_dir):
    folder = scratch_path(spark, "stream-predict")
    stream = _labelled_vectors(_stream(spark, sf_dir, "embeddings"))
    scored = SC.score_rows(stream, _label_predictor(spark, sf_dir), 64, batch_size=BATCH)
    query = ST.stream_rows(
        scored.select("id", "predicted", "loss"), f"{folder}/scored", f"{folder}/checkpoint"
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/scored").withColumn("loss", F.round("loss", 4))


def stream_metrics(spark, sf_dir):
    folder = scratch_path(spark, "stream-metrics")
    pairs = views.pairs_drop_of(_stream(spark, sf_dir, "documents"))
    query = ST.stream_metric_states(
        pairs, ("bleu", "rouge1", "rouge2"), ["lang"], f"{folder}/states", f"{folder}/checkpoint"
    )
    query.awaitTermination()
    report = ST.read_metric_states(spark.read.parquet(f"{folder}/states"), ["lang"])
    return report.select("lang", r6("score", "score"), r6("rouge1", "rouge1"), r6("rouge2", "rouge2"), "n_pairs")


def _arriving_twice(spark, sf_dir, name: str, key: str):
    """A stream of a part of a table, then all of it, so that some rows come again in later batches."""
    folder = scratch_path(spark, "arrivals")
    rows = views.table(spark, sf_dir, name)
    rows.where(F.col(key) % 3 != 0).write.parquet(folder)
    # As many files a batch as the first part has: its rows come before any comes again.
    files = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
    rows.write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def stream_predict_once(spark, sf_dir):
    """Predictions of vectors of which some arrive again: each once."""
    folder = scratch_path(spark, "stream-once")
    stream = SS.once_per_id(_labelled_vectors(_arriving_twice(spark, sf_dir, "embeddings", "vec_id")), "id")
    scored = SC.score_rows(stream, _label_predictor(spark, sf_dir), 64, batch_size=BATCH)
    query = ST.stream_rows(scored.select("id", "predicted", "loss"), f"{folder}/scored", f"{folder}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/scored").withColumn("loss", F.round("loss", 4))


def stream_metrics_once(spark, sf_dir):
    """Metrics of pairs of which some arrive again: each counts once."""
    folder = scratch_path(spark, "stream-metrics-once")
    pairs = SS.once_per_id(views.pairs_drop_of(_arriving_twice(spark, sf_dir, "documents", "doc_id")), "id")
    query = ST.stream_metric_states(
        pairs, ("bleu", "rouge1", "rouge2"), ["lang"], f"{folder}/states", f"{folder}/checkpoint"
    )
    query.awaitTermination()
    report = ST.read_metric_states(spark.read.parquet(f"{folder}/states"), ["lang"])
    return report.select("lang", r6("score", "score"), r6("rouge1", "rouge1"), r6("rouge2", "rouge2"), "n_pairs")


def stream_sums(spark, sf_dir):
    """Running sums of a language in the state store, over captions of which some arrive again."""
    folder = scratch_path(spark, "stream-sums")
    captions = views.captions_of(_arriving_twice(spark, sf_dir, "documents", "doc_id"))
    sizes = captions.select("lang", "caption_id", F.size(X.whitespace_tokens("caption")).alias("length"))
    sums = SS.running_sums(sizes, "lang", "caption_id", ["length"])
    ST.stream_batches(sums, lambda b: b, f"{folder}/sums", f"{folder}/checkpoint", "update").awaitTermination()
    latest = SS.latest_sums(spark.read.parquet(f"{folder}/sums"), "lang", ["length"])
    return latest.select("lang", F.col("n").cast("long").alias("n"), F.col("length").cast("long").alias("length"))


def stream_lengths(spark, sf_dir):
    """The length profile from a sketch of each micro-batch."""
    folder = scratch_path(spark, "stream-lengths")
    stream = views.captions_of(_stream(spark, sf_dir, "documents"))

    def work(batch: DataFrame) -> DataFrame:
        lengths = jobs.preprocess(batch, PreprocessSettings(num_train_data=0))
        return Q.length_state(lengths, LENGTH)

    ST.stream_batches(stream, work, f"{folder}/states", f"{folder}/checkpoint").awaitTermination()
    states = spark.read.parquet(f"{folder}/states").drop("batch_id")
    return _profile_checked(_lengths(spark, sf_dir), Q.merge_length_states(states))


QUERIES = {
    f.__name__: f
    for f in (
        caption_scan,
        caption_lengths,
        caption_lengths_head,
        length_profile,
        length_sketch,
        lengths_csv,
        token_kinds,
        subword_lengths,
        shuffle_head,
        shuffle_rank,
        batch_assign,
        buffer_shuffle,
        train_buffer,
        train_data,
        vocab_build,
        vocab_encode,
        vocab_decode,
        labels_pad_branch,
        labels_nopad_branch,
        labels_unmask,
        source_scan,
        source_stream,
        pairs_join,
        union_predictions,
        ngram_counts,
        ngram_clipped,
        bleu_corpus,
        bleu_corpus_conv,
        bleu_by_lang,
        bleu_ratio_form,
        bleu_state_merge,
        rouge1,
        rouge2,
        rouge_rows_conv,
        rouge_l,
        rouge_l_rows_conv,
        rouge_lsum,
        rouge_bootstrap,
        meteor_exact,
        meteor,
        user_metric,
        metrics_report,
        metrics_report_full,
        metrics_report_subword,
        ce_row_loss,
        ce_row_loss_arrays,
        split_vocabulary_loss,
        eval_loss_batched,
        eval_loss_token,
        eval_schedule,
        best_checkpoint,
        runs_table,
        training_log,
        next_token_table,
        next_token_by_picture,
        beam_step1,
        beam_search,
        predictions_table,
        evaluate_job,
        beam_search_shared,
        beam_no_repeat3,
        predictions_heldout,
        predictions_model,
        metrics_with_nulls,
        head_many,
        batch_inference,
        user_batches,
        image_pixels,
        train_pixels,
        stream_prepare,
        stream_predict,
        stream_metrics,
        stream_predict_once,
        stream_metrics_once,
        stream_sums,
        stream_lengths,
    )
}
