"""Keyed state of streams, and tables that take a step again."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.operators import loss as LO
from capstan.operators import quantiles as Q
from capstan.plans import jobs
from capstan.settings import TrainDataSettings
from capstan.sources import sinks
from capstan.streaming import jobs as ST
from capstan.streaming import state as SS

SCHEMA = "id long, lang string, size long"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_an_id_that_comes_again_counts_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        ST.stream_rows(SS.once_per_id(stream, "id"), out, checkpoint).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    arrive(spark, source, [(k, "x", k) for k in range(9)] + [(3, "again", 0)])
    arrive(spark, source, [(k, "y", 100 + k) for k in range(5, 15)])
    first = run()
    assert [r[0] for r in first] == list(range(15))
    # A new run of the same stream remembers.
    arrive(spark, source, [(k, "z", 0) for k in range(10, 20)])
    assert [r[0] for r in run()] == list(range(20))


def test_sums_of_groups(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = [(k, "xyz"[k % 3], k * k) for k in range(60)]

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        sums = SS.running_sums(stream, "lang", "id", ["size"], salts=3)
        ST.stream_batches(sums, lambda b: b, out, checkpoint, "update").awaitTermination()
        found = SS.latest_sums(spark.read.parquet(out), "lang", ["size"]).collect()
        return {r["lang"]: (r["n"], r["size"]) for r in found}

    def wanted(some):
        groups = {lang for _, lang, _ in some}
        return {g: (sum(r[1] == g for r in some), sum(r[2] for r in some if r[1] == g)) for g in groups}

    arrive(spark, source, rows[:30])
    arrive(spark, source, rows[10:40])
    assert run() == wanted(rows[:40])
    arrive(spark, source, rows)
    assert run() == wanted(rows)


def test_a_repeated_step_leaves_one_record(spark, tmp_path):
    path = str(tmp_path / "runs")

    def commit(run, step, loss, **more):
        columns = {"eval_loss": F.lit(loss), **{k: F.lit(v) for k, v in more.items()}}
        one = spark.range(1).select(F.lit(run).alias("run_id"), F.lit(step).cast("long").alias("step"))
        sinks.commit_run(one.withColumns(columns), path)

    commit("007", 1, 0.5)
    commit("007", 2, 0.7)
    commit("other", 1, 0.9, bleu=3.0)
    commit("007", 1, 0.4)
    rows = sorted((r["run_id"], r["step"], r["eval_loss"], r["bleu"]) for r in sinks.read_runs(spark, path).collect())
    assert rows == [("007", 1, 0.4, None), ("007", 2, 0.7, None), ("other", 1, 0.9, 3.0)]


def test_training_log(spark, tmp_path):
    rows = [(step, i, float((step - 6) ** 2 + i), 1 + i % 2) for step in range(14) for i in range(5)]
    losses = spark.createDataFrame(rows, "step long, id long, loss double, tokens long").repartition(3)
    settings = TrainDataSettings(
        output_dir=str(tmp_path), eval_steps=3, num_train_data=11, train_batch_size=1, valid_batch_size=2
    )
    for _ in range(2):
        best = jobs.run_training_log(losses, settings, "r").collect()
        assert [(r["run_id"], r["step"]) for r in best] == [("r", 6)]
    jobs.run_training_log(losses.where("step > 6"), settings, "s")
    runs = {(r["run_id"], r["step"]): r for r in sinks.read_runs(spark, f"{tmp_path}/runs").collect()}
    assert sorted(runs) == [("r", 3), ("r", 6), ("r", 9), ("s", 9)]
    batches = [[(9 + i, 1 + i % 2) for i in b] for b in ((0, 1), (2, 3), (4,))]
    means = [(sum(x for x, _ in b) / sum(t for _, t in b), len(b)) for b in batches]
    assert runs["r", 3]["eval_loss"] == pytest.approx(sum(m * n for m, n in means) / 5)
    assert runs["r", 3]["settings"]["eval_steps"] == 3 and runs["r", 9]["n_rows"] == 5


def test_logits_in_parts(spark):
    rng = np.random.default_rng(4)
    rows, wanted = [], {}
    for i in range(6):
        for pos in range(3):
            logits = rng.normal(size=10) * 10 ** rng.integers(0, 4)
            label = -100 if (i + pos) % 4 == 0 else int(rng.integers(0, 10))
            top = logits.max()
            loss = 0.0 if label < 0 else math.log(np.exp(logits - top).sum()) + top - logits[label]
            total, tokens = wanted.get(i, (0.0, 0))
            wanted[i] = (total + loss, tokens + (label >= 0))
            cuts = sorted({0, 10, *rng.integers(0, 11, 3).tolist()})
            rows += [(i, pos, label, a, [float(x) for x in logits[a:b]]) for a, b in zip(cuts, cuts[1:])]
            rows.append((i, pos, label, 3, []))
    schema = "id long, pos int, label int, first int, logits array<double>"
    parts = spark.createDataFrame(rows, schema).repartition(4)
    got = {r["id"]: (r["loss"], r["tokens"]) for r in LO.split_row_losses(parts).collect()}
    assert {k: pytest.approx(v) for k, v in wanted.items()} == got
    # Parts of parts, in any order.
    states = LO.logit_states(parts)
    halves = [LO.merge_logit_states(states.where(F.col("own").isNull() == flag)) for flag in (True, False)]
    merged = LO.merge_logit_states(halves[0].unionByName(halves[1]))
    again = LO.state_losses(merged).groupBy("id").agg(F.sum("loss").alias("loss"))
    assert {r["id"]: pytest.approx(r["loss"]) for r in again.collect()} == {k: v[0] for k, v in wanted.items()}
    plan = LO.merge_logit_states(states)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("shape", ["even", "ties", "long", "one"])
def test_percentiles_within_their_bound(spark, shape):
    rng = np.random.default_rng(5)
    values = {
        "even": rng.permutation(30_000),
        "ties": rng.integers(0, 4, 30_000),
        "long": (rng.pareto(0.7, 30_000) * 10).astype(np.int64),
        "one": np.array([7]),
    }[shape]
    rows = [(int(v), "abc"[i % 3]) for i, v in enumerate(values)]
    lengths = spark.createDataFrame([*rows, (None, "a")], "length long, part string").repartition(5)
    states = Q.length_state(lengths, 5, ["part"])
    profile = Q.finish_lengths(Q.merge_length_states(states)).first()
    assert (profile["n"], profile["min_length"], profile["max_length"]) == (len(values), values.min(), values.max())
    assert profile["avg_length"] == pytest.approx(values.mean()) and profile["share_over"] == pytest.approx((values > 5).mean())
    for q in Q.QUANTILES:
        value = profile[f"p{round(100 * q)}"]
        low, high = (values < value).mean(), (values <= value).mean()
        assert low - Q.RANK_ERROR <= q <= high + Q.RANK_ERROR
    known = lengths.where("length IS NOT NULL")
    off = Q.rank_errors(known, Q.finish_lengths(Q.merge_length_states(states))).first()
    assert all(x <= Q.RANK_ERROR for x in off)
