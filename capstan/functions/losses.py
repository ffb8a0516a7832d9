"""Cross-entropy as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capstan.functions.labels import IGNORED


def token_loss(logits: Column, label: Column) -> Column:
    """-log softmax(logits)[label], 0 where the label is ignored.

    The maximum is taken out first, so large logits do not overflow.
    """
    values = F.transform(logits, lambda x: x.cast("double"))
    top = F.array_max(values)
    mass = F.aggregate(values, F.lit(0.0), lambda total, x: total + F.exp(x - top))
    loss = F.log(mass) + top - F.get(values, label)
    return F.when(label == IGNORED, F.lit(0.0)).otherwise(loss)
