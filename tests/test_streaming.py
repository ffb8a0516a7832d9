from pyspark.sql import functions as F

from capstan.operators import report as R
from capstan.operators import scoring as SC
from capstan.operators import vocabulary as V
from capstan.plans import jobs
from capstan.schemas import CAPTIONS
from capstan.settings import Settings
from capstan.sources.captions import stream_captions
from capstan.streaming import jobs as ST

PAIRS = "id long, prediction array<string>, reference array<string>"


def write_pairs(spark, path, ids):
    rows = [(i, list("abcde"[: i % 6]), list("abxde")) for i in ids]
    spark.createDataFrame(rows, PAIRS).coalesce(1).write.mode("append").parquet(path)


def test_metric_states_over_two_runs(spark, tmp_path):
    source, states, checkpoint = (str(tmp_path / n) for n in ("in", "states", "checkpoint"))
    metrics = ("bleu", "rouge1", "rougeL")

    def run():
        stream = spark.readStream.schema(PAIRS).option("maxFilesPerTrigger", 1).parquet(source)
        ST.stream_metric_states(stream, metrics, [], states, checkpoint).awaitTermination()
        return ST.read_metric_states(spark.read.parquet(states)).first().asDict()

    write_pairs(spark, source, range(7))
    run()
    write_pairs(spark, source, range(7, 20))
    second = run()
    # The same checkpoint again: nothing is added.
    assert run() == second
    whole = R.finish_metrics(R.metric_state(spark.read.parquet(source), metrics)).first().asDict()
    assert {k: str(v)[:12] for k, v in whole.items()} == {k: str(v)[:12] for k, v in second.items()}
    assert second["n_pairs"] == 20


def test_repeated_batch_overwrites_itself(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_pairs(spark, source, range(5))
    for run in ("one", "two"):
        stream = spark.readStream.schema(PAIRS).parquet(source)
        query = ST.stream_batches(stream, lambda b: b.select("id"), out, str(tmp_path / run))
        query.awaitTermination()
    assert spark.read.parquet(out).count() == 5


def test_predict_each_arrival_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = spark.range(6).select("id", F.array(F.col("id").cast("float"), F.lit(2.5).cast("float")).alias("features"), F.lit(0).alias("label"))
    schema = "id long, features array<float>, label int"
    for part in (rows.where("id < 4"), rows.where("id >= 4")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        scored = SC.score_rows(stream, lambda: lambda features: features, 2, batch_size=2)
        ST.stream_rows(scored, out, checkpoint).awaitTermination()
    found = {r["id"]: r["predicted"] for r in spark.read.parquet(out).collect()}
    assert found == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
    assert spark.read.parquet(out).count() == 6


def test_prepare_new_captions(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    texts = ["a dog runs", "the cat", "", "a cat runs far away"]
    rows = [(k, f"img/{k}.png", k, t, None, None, 8, 8, "train") for k, t in enumerate(texts)]
    captions = spark.createDataFrame(rows, CAPTIONS)
    vocabulary = V.build_vocabulary(captions.select(F.split("caption", " ").alias("t")), "t")
    settings = Settings(max_sequence_length=6)
    for part in (captions.where("caption_id < 2"), captions.where("caption_id >= 2")):
        part.coalesce(1).write.mode("append").parquet(source)
        work = lambda batch: jobs.caption_labels(batch, vocabulary, settings)
        ST.stream_batches(stream_captions(spark, source), work, out, checkpoint).awaitTermination()
    streamed = {r["caption_id"]: r["labels"] for r in spark.read.parquet(out).collect()}
    batch = {r["caption_id"]: r["labels"] for r in jobs.caption_labels(captions, vocabulary, settings).collect()}
    assert streamed == batch and len(batch) == 4
