"""The jobs a user runs: preprocess, train data, predict, evaluate."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions import labels as L
from capstan.functions.pixels import SIDE
from capstan.functions.text import first_tokens, tokenize
from capstan.operators import fitting as FI
from capstan.operators import generation as G
from capstan.operators import loss as LO
from capstan.operators import model_search as MS
from capstan.operators import report
from capstan.operators import sampling as S
from capstan.operators import vocabulary as V
from capstan.operators.buffered import buffered_shuffle
from capstan.schemas import PREDICTIONS
from capstan.session import stored
from capstan.settings import (
    EvaluateSettings,
    PredictSettings,
    PreprocessSettings,
    Settings,
    TrainDataSettings,
    settings_column,
)
from capstan.sources import sinks
from capstan.sources.caption_source import CONFIG, load_captions
from capstan.sources.pictures import (
    Measures,
    PackedPictures,
    join_pictures,
    packed_pictures,
    pixel_features,
    read_extractor,
    read_pictures_at,
    with_pixels,
)


def caption_tokens(settings: Settings):
    return tokenize("caption", settings.tokenizer, settings.tokenizer_name_or_path)


def preprocess(captions: DataFrame, settings: PreprocessSettings) -> DataFrame:
    """(caption_id, length) of the first captions; untruncated lengths."""
    first = S.head(captions.select("caption_id", "caption"), settings.num_train_data, "caption_id")
    return first.select("caption_id", F.size(caption_tokens(settings)).alias("length"))


def run_preprocess(captions: DataFrame, settings: PreprocessSettings) -> sinks.Written:
    return sinks.write_csv(preprocess(captions, settings), f"{settings.output_dir}/preprocessed_train.csv")


def length_profile(lengths: DataFrame, max_length: int, group_cols: list[str] = ()) -> DataFrame:
    """n, min, max, mean, percentiles and the share beyond ``max_length``."""
    quantile = lambda q: F.percentile("length", F.lit(q))
    return lengths.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        F.avg("length").alias("avg_length"),
        quantile(0.5).alias("p50"),
        quantile(0.95).alias("p95"),
        quantile(0.99).alias("p99"),
        F.avg((F.col("length") > max_length).cast("double")).alias("share_over"),
    )


def caption_labels(
    captions: DataFrame,
    vocabulary: DataFrame,
    settings: Settings,
    pad_id: int | None = V.PAD,
    lower: bool = True,
) -> DataFrame:
    """(caption_id, labels): ids between marks, cut, padded and masked.

    Tokens that the cut would drop are dropped before the lookup.
    """
    length = settings.max_sequence_length
    text = F.lower("caption") if lower else F.col("caption")
    tokens = first_tokens(text, length - 2, settings.tokenizer, settings.tokenizer_name_or_path)
    ids = V.encode(captions.select("caption_id", tokens.alias("tokens")), "caption_id", "tokens", vocabulary)
    framed = L.add_special("ids", length, V.CLS, V.SEP)
    return ids.select("caption_id", L.make_labels(framed, length, pad_id).alias("labels"))


def features(
    captions: DataFrame, labels: DataFrame, pixels: DataFrame | PackedPictures | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Model inputs (caption_id, id, labels[, pixel_values and measures]) of the declared types.

    Rows are keyed by caption; captions of one picture share its ``id``. All
    other columns of the captions but those to ``keep`` are dropped.
    """
    rows = captions.withColumn("id", F.col("image_id").cast("long")).join(labels, "caption_id")
    inputs = ["caption_id", "id", "labels", *keep]
    if pixels is not None:
        declared = L.checked_array("pixel_values", "float", 3 * SIDE * SIDE, "pixel_values")
        # Nothing else of the captions moves to the pictures.
        rows = rows.select(*dict.fromkeys([*inputs, "image_path"]))
        packed = isinstance(pixels, PackedPictures)
        rows = with_pixels(join_pictures(rows, pixels.rows), pixels) if packed else join_pictures(rows, pixels)
        rows = rows.withColumn("pixel_values", declared)
        inputs += ["pixel_values", *(pixels.measures if packed else ())]
    return rows.select(*inputs)


def split_captions(spark: SparkSession, data_dir: str, split: str, config: str = CONFIG) -> DataFrame:
    """The caption records of a split below a data folder, as the settings name them."""
    return load_captions(spark, data_dir, config, split)


def train_captions(spark: SparkSession, settings: PreprocessSettings | TrainDataSettings) -> DataFrame:
    return split_captions(spark, settings.train_data_dir, "train")


def valid_captions(spark: SparkSession, settings: TrainDataSettings) -> DataFrame:
    return split_captions(spark, settings.valid_data_dir, "validation")


def held_out_captions(spark: SparkSession, settings: EvaluateSettings) -> DataFrame:
    return split_captions(spark, settings.test_data_dir, settings.test_data_split)


def picture_inputs(captions: DataFrame, settings: Settings) -> DataFrame:
    """(image_path, pixel_values) of the pictures that captions name, each opened once by its path.

    ``feature_extractor_name_or_path`` names a folder or JSON file with the size,
    mean and deviation of the model's input; without one those are the usual.
    """
    prepared = read_extractor(getattr(settings, "feature_extractor_name_or_path", None))
    return pixel_features(read_pictures_at(captions), **prepared)


def packed_inputs(captions: DataFrame, settings: Settings, measures: Measures | None = None) -> PackedPictures:
    """The pictures of :func:`picture_inputs` small, for joins: :func:`features` makes the values, and measures, after."""
    prepared = read_extractor(getattr(settings, "feature_extractor_name_or_path", None))
    return packed_pictures(read_pictures_at(captions), **prepared, measures=measures)


def saved_model(features: DataFrame, settings: EvaluateSettings) -> PictureModel:
    """The caption model in the file that ``predictor_path`` names, shipped to the tasks."""
    if not settings.predictor_path:
        raise ValueError("predictor_path names no model")
    return PictureModel(FI.caption_model(FI.ship_file(features.sparkSession, settings.predictor_path)), features)


@dataclass
class TrainData:
    train: DataFrame
    valid: DataFrame
    max_steps: DataFrame


def _ordered(rows: DataFrame, settings: EvaluateSettings | TrainDataSettings) -> DataFrame:
    """Rows with their place in the shuffled order of their split, where a buffer shuffles them."""
    return stored(buffered_shuffle(rows, settings.shuffle_buffer, settings.random_seed), "buffered")


def prepare_train(
    train: DataFrame,
    valid: DataFrame,
    vocabulary: DataFrame,
    settings: TrainDataSettings,
    pixels: DataFrame | PackedPictures | None = None,
) -> TrainData:
    """Shuffled training rows, the first validation rows and the step count.

    ``num_train_data`` sets the steps only; no training row is left out. The
    validation rows are not shuffled. With a buffer the training rows have their
    ``split_id`` and ``position`` there, in place of one order of all rows. With
    ``pixels`` (image_path, pixel_values), or packed ones, rows have those of their picture.
    """
    if settings.shuffle_order == "buffer":
        placed = _ordered(train, settings)
        shuffled = features(placed, caption_labels(train, vocabulary, settings), pixels, ("split_id", "position"))
    else:
        prepared = features(train, caption_labels(train, vocabulary, settings), pixels)
        shuffled = S.shuffled(prepared, settings.random_seed, "caption_id")
    first = S.head(valid, settings.num_valid_data, "caption_id")
    steps = settings.num_train_epochs * settings.num_train_data // settings.train_batch_size
    return TrainData(
        train=shuffled,
        valid=features(first, caption_labels(first, vocabulary, settings), pixels),
        max_steps=train.sparkSession.range(1).select(F.lit(steps).cast("long").alias("max_steps")),
    )


def select_test(captions: DataFrame, settings: EvaluateSettings) -> DataFrame:
    """The test rows: seeded order where asked, then the first n."""
    if settings.num_test_data <= 0:
        return captions
    if settings.shuffle and settings.shuffle_order == "buffer":
        placed = _ordered(captions, settings)
        return S.head(placed, settings.num_test_data, "split_id", "position").drop("split_id", "position")
    if settings.shuffle:
        return S.shuffled_head(captions, settings.num_test_data, settings.random_seed, "caption_id")
    return S.head(captions, settings.num_test_data, "caption_id")


def caption_sequences(captions: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(image_id, caption_id, seq): lower-cased tokens between marks.

    With settings the tokens are those of the labels: their tokenizer, and cut
    where they are cut. A null caption has no tokens.
    """
    text = F.coalesce(F.lower("caption"), F.lit(""))
    if settings is None:
        return captions.select("image_id", "caption_id", G.marked(tokenize(text, "whitespace")).alias("seq"))
    kept = first_tokens(text, settings.max_sequence_length - 2, settings.tokenizer, settings.tokenizer_name_or_path)
    return captions.select("image_id", "caption_id", G.marked(kept).alias("seq"))


@dataclass
class TokenModel:
    """Written bigram counts, per value of ``by`` or, without, one table for all."""

    counts: DataFrame
    by: list[str]


def fit_tokens(captions: DataFrame, settings: Settings, by: list[str] = ()) -> TokenModel:
    """The next-token model of some captions; several passes read it."""
    by = list(by)
    return TokenModel(stored(G.bigrams(caption_sequences(captions, settings), by, "seq"), "bigrams"), by)


def _generated(captions: DataFrame, settings: EvaluateSettings, model: TokenModel, key: str = "image_id") -> DataFrame:
    start_length = 1 + settings.prompt_tokens
    columns = [key, *[c for c in model.by if c != key]]
    words = F.filter("seq", lambda t: t != G.END)
    if key == "image_id":
        starts = captions.select("image_id").distinct().withColumn("seq", F.array(F.lit(G.START)))
    else:
        prompt = F.slice(words, 1, start_length).alias("seq")
        starts = caption_sequences(captions, settings).select(*columns, prompt)
    width = 2 * settings.num_beams + start_length + settings.max_new_tokens
    best = G.beam_search(
        G.next_tokens(model.counts, model.by, width),
        starts,
        columns,
        num_beams=settings.num_beams,
        max_new_tokens=settings.max_new_tokens,
        start_length=start_length,
        table_by=model.by,
        no_repeat_size=settings.no_repeat_ngram_size,
        # Tables by the beams' own keys are sized as they are searched.
        rows=None if columns == model.by else model.counts.count(),
    )
    return best.select(key, G.generated_text("seq").alias("predicted"), "score")


def generate(captions: DataFrame, settings: EvaluateSettings, model: TokenModel | None = None) -> DataFrame:
    """(key, predicted, score): the best continuation of every prompt.

    Without a model each picture has that of its own captions, and one beam
    search per picture starts from the start mark (key ``image_id``). A model is
    asked once per caption (key ``caption_id``), from the start mark and the first
    ``prompt_tokens`` tokens.
    """
    if model is None:
        by = ["image_id"]
        # Read once, where it is counted.
        own = TokenModel(G.bigrams(caption_sequences(captions, settings), by, "seq"), by)
        return _generated(captions, settings, own)
    return _generated(captions, settings, model, "caption_id")


def caption_losses(captions: DataFrame, model: TokenModel, settings: Settings) -> DataFrame:
    """(caption_id, loss, tokens): summed loss of a caption's labels under the model.

    The labels run from the start mark over the kept tokens to the end mark;
    every label after the first counts. Neighbours that the model has not seen
    have the score ``UNSEEN``.
    """
    scores = G.token_scores(model.counts, model.by).select(*model.by, "prev", "next", "logp")
    columns = ["caption_id", *[c for c in model.by if c != "caption_id"]]
    steps = G.neighbours(caption_sequences(captions, settings), columns, "seq")
    scored = steps.join(scores.hint("merge"), [*model.by, "prev", "next"], "left")
    logp = F.coalesce("logp", F.lit(G.UNSEEN))
    return scored.groupBy("caption_id").agg(
        (-F.sum(logp) / G.SCORE_UNIT).alias("loss"), F.count(F.lit(1)).alias("tokens")
    )


@dataclass
class PictureModel:
    """A model of captions given features of their picture (image_id, features); its token ids are the vocabulary's."""

    make: Callable[[], MS.Model]
    features: DataFrame


def _with_features(rows: DataFrame, model: PictureModel) -> DataFrame:
    """Rows beside their picture's features; a row whose picture has none fails the job."""
    joined = rows.join(model.features.select("image_id", "features"), "image_id", "left")
    message = F.concat(F.lit("no features of picture "), F.coalesce(F.col("image_id").cast("string"), F.lit("null")))
    checked = F.when(F.col("features").isNotNull(), F.col("features")).otherwise(F.raise_error(message))
    return joined.withColumn("features", checked)


def generate_by_model(
    captions: DataFrame, vocabulary: DataFrame, settings: EvaluateSettings, model: PictureModel
) -> DataFrame:
    """(image_id, predicted, score): the caption that a model gives each picture, from the start mark."""
    starts = captions.select("image_id").distinct().withColumn("seq", F.array(F.lit(V.CLS)))
    best = MS.model_search(
        _with_features(starts, model).select("image_id", "features"),
        starts,
        ["image_id"],
        model.make,
        V.SEP,
        num_beams=settings.num_beams,
        max_new_tokens=settings.max_new_tokens,
        no_repeat_size=settings.no_repeat_ngram_size,
        batch_size=settings.test_batch_size,
    )
    text = V.decode(best, "image_id", "seq", vocabulary, name="predicted")
    return text.join(best.select("image_id", "score"), "image_id")


def model_losses(
    labels: DataFrame, captions: DataFrame, settings: EvaluateSettings, model: PictureModel
) -> DataFrame:
    """(caption_id, loss, tokens): summed loss of the labels under a model, as :func:`caption_losses`."""
    rows = _with_features(captions.select("caption_id", "image_id").join(labels, "caption_id"), model)
    return MS.sequence_losses(rows, model.make, "caption_id", batch_size=settings.test_batch_size)


def predict(
    captions: DataFrame,
    vocabulary: DataFrame,
    settings: PredictSettings,
    model: TokenModel | PictureModel | None = None,
) -> DataFrame:
    """(id, image_id, loss, tokens, predicted_labels, labels) of the test captions.

    A ``TokenModel`` may have been fitted on other captions, which the test rows
    are then scored against; a ``PictureModel`` scores batches of sequences from
    the features of their picture; without one each picture has the token model
    of its own captions. Labels go through ids, mask and back, so the text is
    what the model saw, and the loss is that of exactly these labels. A caption
    without a picture fails the job.
    """
    lost = F.raise_error(F.concat(F.lit("no picture: caption "), F.col("caption_id").cast("string")))
    chosen = select_test(captions, settings)
    chosen = chosen.withColumn("image_id", F.coalesce("image_id", lost.cast("long")))
    labels = caption_labels(chosen, vocabulary, settings)
    if isinstance(model, PictureModel):
        predicted = generate_by_model(chosen, vocabulary, settings, model)
        losses = model_losses(labels, chosen, settings, model)
    elif model is not None:
        predicted, losses = generate(chosen, settings, model), caption_losses(chosen, model, settings)
    else:
        own = fit_tokens(captions, settings, ["image_id"])
        pictures = captions.join(chosen.select("image_id").distinct(), "image_id", "left_semi")
        # Dealt out by picture once; tables and searches are made where they are.
        placed = TokenModel(own.counts.repartition(*own.by), own.by)
        predicted, losses = _generated(pictures, settings, placed), caption_losses(chosen, own, settings)
    key = predicted.columns[0]
    unmasked = labels.select("caption_id", L.unmask("labels", V.PAD).alias("ids"))
    text = V.decode(unmasked, "caption_id", "ids", vocabulary, name="labels")
    return (
        chosen.select("caption_id", "image_id")
        .join(losses, "caption_id")
        .join(text, "caption_id")
        .join(predicted, key)
        .select(
            F.col("caption_id").alias("id"),
            "image_id",
            "loss",
            "tokens",
            F.col("predicted").alias("predicted_labels"),
            "labels",
        )
    )


def run_predict(
    captions: DataFrame,
    vocabulary: DataFrame,
    settings: PredictSettings,
    model: TokenModel | PictureModel | None = None,
) -> sinks.Written:
    rows = predict(captions, vocabulary, settings, model).select(*PREDICTIONS.fieldNames())
    return sinks.write_csv(rows, f"{settings.output_dir}/prediction.csv")


def run_evaluate(
    predictions: DataFrame,
    settings: EvaluateSettings,
    step: int = 0,
    metrics=report.METRICS,
    scores=None,
    corpus_scores=None,
    run_id: str | None = None,
) -> DataFrame:
    """Metrics and evaluation loss of a predictions table, committed to the runs table.

    A step of a ``run_id`` that was committed before is replaced; without one the
    run gets an id of its own.

    ``eval_loss`` is the mean of the batches' token means, weighted by their rows.
    ``scores`` and ``corpus_scores`` are a user's own metrics, as in
    :func:`report.evaluate`.
    """
    start = time.monotonic()
    predictions = stored(predictions, "predictions")
    pairs = predictions.select(
        "id", F.col("predicted_labels").alias("prediction"), F.col("labels").alias("reference")
    )
    rows = predictions.select("id", "loss", "tokens")
    losses = LO.evaluation_row_loss(rows, settings.test_batch_size).select("eval_loss", "n_tokens")
    result = report.by_groups(
        [
            report.evaluate(
                pairs, metrics, [], settings.metric_tokenizers(), settings.tokenizer_name_or_path, scores, corpus_scores
            ),
            losses,
        ]
    )
    # One record: the wall time can only be stamped once it is there.
    row = result.collect()
    result = result.sparkSession.createDataFrame(row, result.schema)
    samples = row[0]["n_pairs"]
    steps = -(-samples // settings.test_batch_size)
    run_id = run_id or uuid.uuid4().hex
    record = sinks.run_record(result, settings, run_id, step, time.monotonic() - start, samples, steps)
    sinks.commit_run(record, f"{settings.output_dir}/runs")
    return record


def run_training_log(losses: DataFrame, settings: TrainDataSettings, run_id: str, seconds: float = 1.0) -> DataFrame:
    """Commit the evaluations of a run that are due, and give the best of them.

    ``losses`` is (step, id, loss, tokens): row losses of the validation rows as
    the model stood at a step. Every ``eval_steps`` steps up to the last one their
    evaluation loss, over batches of ``valid_batch_size`` rows, becomes a record
    of the run; the record of lowest loss is the kept checkpoint.
    """
    last = settings.num_train_epochs * settings.num_train_data // settings.train_batch_size
    steps = losses.sparkSession.range(1).select(F.lit(last).cast("long").alias("max_steps"))
    due = stored(S.evaluation_steps(losses, steps, settings.eval_steps).drop("max_steps"), "due")
    path = f"{settings.output_dir}/runs"
    metrics = LO.evaluation_row_loss(due, settings.valid_batch_size, ["step"])
    record = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.col("step").cast("long").alias("step"),
        settings_column(settings).alias("settings"),
        "eval_loss",
        "n_rows",
        "n_tokens",
        F.lit(float(seconds)).alias("eval_runtime"),
        (F.col("n_rows") / seconds).alias("eval_samples_per_second"),
    )
    sinks.commit_run(record, path)
    runs = sinks.read_runs(losses.sparkSession, path)
    return S.best_step(runs.where(F.col("run_id") == run_id), "eval_loss", ["run_id"])
