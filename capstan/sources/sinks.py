"""Result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.settings import Settings, settings_column

_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


@dataclass(frozen=True)
class Written:
    """Where a job put its rows, and how many they were."""

    path: str
    rows: int


def write_csv(df: DataFrame, path: str) -> Written:
    """CSV with a header, one file per task; rows are keyed, not numbered.

    They are counted as they are written.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**_CSV).csv(path)
    return Written(path, seen.get["rows"])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.options(**_CSV, multiLine=True).schema(schema).csv(path)


def run_record(
    metrics: DataFrame, settings: Settings, run_id: str, step: int, seconds: float, samples: int, steps: int
) -> DataFrame:
    """One row: settings, metrics, wall seconds and rates of a run's step."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(step).cast("long").alias("step"),
        settings_column(settings).alias("settings"),
        "*",
        F.lit(seconds).alias("eval_runtime"),
        F.lit(samples / seconds).alias("eval_samples_per_second"),
        F.lit(steps / seconds).alias("eval_steps_per_second"),
    )


def commit_run(record: DataFrame, path: str) -> None:
    """Put the records of some steps of runs into the table; a step that is there already is replaced.

    Steps are folders (run_id, step) of the table, and a job replaces only the
    folders it writes, so a retried job leaves one record of its step.
    """
    writer = record.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id", "step").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All records, whatever metrics they hold; run ids that look like numbers stay text."""
    runs = spark.read.option("mergeSchema", True).parquet(path)
    names = [c for c in runs.columns if c not in ("run_id", "step")]
    return runs.select(F.col("run_id").cast("string"), F.col("step").cast("long"), *names)
