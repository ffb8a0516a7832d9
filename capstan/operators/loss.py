"""Row losses and evaluation losses from logits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capstan.functions.labels import IGNORED
from capstan.functions.losses import token_loss
from capstan.operators.ranking import global_rank
from capstan.operators.sampling import batches


def flatten_positions(rows: DataFrame) -> DataFrame:
    """(id, labels, logits) arrays to one row per position."""
    zipped = F.arrays_zip("labels", "logits")
    return rows.select("id", F.posexplode(zipped).alias("pos", "e")).select(
        "id", "pos", F.col("e.labels").alias("label"), F.col("e.logits").alias("logits")
    )


def position_losses(positions: DataFrame) -> DataFrame:
    """(id, pos, loss, counted): counted is 1 where the label is not ignored."""
    return positions.select(
        "id",
        "pos",
        token_loss(F.col("logits"), F.col("label")).alias("loss"),
        (F.col("label") != IGNORED).cast("int").alias("counted"),
    )


def logit_states(parts: DataFrame) -> DataFrame:
    """(id, pos, label, top, mass, own): what the logits of a part of the vocabulary add to a loss.

    ``parts`` is (id, pos, label, first, logits): consecutive logits from token
    ``first`` on, any number of rows a position. ``top`` is their maximum, ``mass``
    the sum of exp(x - top), ``own`` the label's logit if it is among them.
    """
    values = F.transform("logits", lambda x: x.cast("double"))
    at = F.col("label") - F.col("first")
    rows = parts.where(F.size("logits") > 0).select("id", "pos", "label", at.alias("at"), values.alias("x"))
    rows = rows.withColumn("top", F.array_max("x"))
    mass = F.aggregate("x", F.lit(0.0), lambda total, x: total + F.exp(x - F.col("top")))
    own = F.when((F.col("at") >= 0) & (F.col("at") < F.size("x")), F.get("x", F.col("at")))
    return rows.select("id", "pos", "label", "top", mass.alias("mass"), own.alias("own"))


def merge_logit_states(states: DataFrame) -> DataFrame:
    """States of parts as one per position; parts of parts merge in any order.

    The largest maximum of a position is found by a window over the same keys
    that the sums group by, so both take one shuffle.
    """
    highest = F.max("top").over(Window.partitionBy("id", "pos"))
    scaled = states.withColumn("highest", highest)
    return scaled.groupBy("id", "pos").agg(
        F.max("label").alias("label"),
        F.max("highest").alias("top"),
        F.sum(F.col("mass") * F.exp(F.col("top") - F.col("highest"))).alias("mass"),
        F.max("own").alias("own"),
    )


def state_losses(states: DataFrame) -> DataFrame:
    """(id, pos, loss, counted) of merged states, as :func:`position_losses`; a label no part holds has no loss."""
    loss = F.log("mass") + F.col("top") - F.col("own")
    return states.select(
        "id",
        "pos",
        F.when(F.col("label") == IGNORED, F.lit(0.0)).otherwise(loss).alias("loss"),
        (F.col("label") != IGNORED).cast("int").alias("counted"),
    )


def split_row_losses(parts: DataFrame) -> DataFrame:
    """(id, loss, tokens) from logits whose vocabulary is split over rows."""
    losses = state_losses(merge_logit_states(logit_states(parts)))
    return losses.groupBy("id").agg(F.sum("loss").alias("loss"), F.sum("counted").alias("tokens"))


def row_losses(positions: DataFrame) -> DataFrame:
    """(id, loss, tokens): sum over a row's positions; ignored ones add 0."""
    return (
        position_losses(positions)
        .groupBy("id")
        .agg(F.sum("loss").alias("loss"), F.sum("counted").alias("tokens"))
    )


def batch_row_losses(rows: DataFrame, batch_size: int, group_cols: list[str] = ()) -> DataFrame:
    """(batch, rows, tokens, eval_loss) of (id, loss, tokens): token mean of each batch of rows.

    A batch whose positions are all ignored has no loss. With groups, each has
    batches of its own, numbered from 0.
    """
    group_cols = list(group_cols)
    if group_cols:
        ranked = global_rank(rows, *group_cols, "id", name="__row")
        firsts = ranked.groupBy(*group_cols).agg(F.min("__row").alias("__first"))
        place = F.floor((F.col("__row") - F.col("__first")) / batch_size)
        numbered = ranked.join(firsts, group_cols).withColumn("batch", place)
    else:
        numbered = batches(rows, batch_size, "id")
    return numbered.groupBy(*group_cols, "batch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("tokens").alias("tokens"),
        F.try_divide(F.sum("loss"), F.sum("tokens")).alias("eval_loss"),
    )


def batch_losses(positions: DataFrame, batch_size: int) -> DataFrame:
    return batch_row_losses(row_losses(positions), batch_size)


def evaluation_row_loss(rows: DataFrame, batch_size: int, group_cols: list[str] = ()) -> DataFrame:
    """Mean of the batch losses of (id, loss, tokens), weighted by their rows, per group."""
    losses = batch_row_losses(rows, batch_size, group_cols)
    counted = F.when(F.col("eval_loss").isNotNull(), F.col("rows"))
    weighted = F.try_divide(F.sum(F.col("eval_loss") * F.col("rows")), F.sum(counted))
    return losses.groupBy(*group_cols).agg(weighted.alias("eval_loss"), F.sum("rows").alias("n_rows"), F.sum("tokens").alias("n_tokens"))


def evaluation_loss(positions: DataFrame, batch_size: int) -> DataFrame:
    return evaluation_row_loss(row_losses(positions), batch_size)


def token_mean_loss(positions: DataFrame) -> DataFrame:
    """Mean over all positions that count."""
    return position_losses(positions).agg(
        F.try_divide(F.sum("loss"), F.sum("counted")).alias("token_loss"),
        F.sum("counted").alias("n_tokens"),
    )
