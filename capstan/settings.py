"""Settings of the jobs; they travel as a struct column of the runs table."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields
from pathlib import PurePath

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """Fields every job has."""

    output_dir: str = "output"
    max_sequence_length: int = 64
    random_seed: int = 42
    tokenizer: str = "whitespace"
    tokenizer_name_or_path: str | None = None


@dataclass(frozen=True)
class PreprocessSettings(Settings):
    train_data_dir: str = "../input/coco-2014-train/"
    num_train_data: int = 82783


@dataclass(frozen=True)
class EvaluateSettings(Settings):
    test_data_dir: str = "../input/coco-2014-val/"
    test_data_split: str = "validation"
    predictor_path: str | None = None
    feature_extractor_name_or_path: str | None = None
    max_new_tokens: int = 16
    num_beams: int = 5
    no_repeat_ngram_size: int = 2
    prompt_tokens: int = 0
    test_batch_size: int = 32
    num_test_data: int = 0
    shuffle: bool = True
    # "key": one seeded order of all rows; "buffer": a buffer in each split of the input.
    shuffle_order: str = "key"
    shuffle_buffer: int = 10_000
    bleu_tokenizer: str | None = None
    rouge_tokenizer: str | None = None
    meteor_tokenizer: str | None = None

    def metric_tokenizers(self) -> dict[str, str]:
        """Tokenizer of each metric family; the common one where none is set."""
        return {
            "bleu": self.bleu_tokenizer or self.tokenizer,
            "rouge": self.rouge_tokenizer or self.tokenizer,
            "meteor": self.meteor_tokenizer or self.tokenizer,
        }


@dataclass(frozen=True)
class PredictSettings(EvaluateSettings):
    pass


@dataclass(frozen=True)
class TrainDataSettings(Settings):
    train_data_dir: str = "../input/coco-2014-train/"
    valid_data_dir: str = "../input/coco-2014-val/"
    max_new_tokens: int = 16
    num_train_epochs: int = 1
    train_batch_size: int = 32
    valid_batch_size: int = 32
    num_train_data: int = 10000
    num_valid_data: int = 1000
    eval_steps: int = 600
    shuffle_order: str = "key"
    shuffle_buffer: int = 1_000


def settings_column(settings: Settings) -> Column:
    """The settings as one struct literal: paths as strings, sets as sorted lists."""
    values = asdict(settings)
    parts = []
    for field in fields(settings):
        value = values[field.name]
        if isinstance(value, PurePath):
            value = str(value)
        if isinstance(value, (set, frozenset)):
            value = sorted(value)
        if isinstance(value, (list, tuple)):
            column = F.array(*[F.lit(item) for item in value])
        elif value is None:
            column = F.lit(None).cast("string")
        else:
            column = F.lit(value)
        parts.append(column.alias(field.name))
    return F.struct(*parts)
