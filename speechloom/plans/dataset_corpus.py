"""Dataset splits with embedded waveforms to manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechloom.functions.paths import name_audio_file
from speechloom.operators.embedded import decoded_audio, is_embedded
from speechloom.operators.ladders import (
    guard_text,
    manifest_text,
    skip_reason_dataset,
    skip_summary,
    to_manifest,
)
from speechloom.operators.splits import split_summary
from speechloom.operators.waveforms import export_audio_files, resampled_wavs
from speechloom.sources.datasets import first_n
from speechloom.sources.manifests import write_manifest
from speechloom.workspace import written_at


def explain_dataset(
    df: DataFrame,
    shortest: float = 0.1,
    longest: float = 20.0,
    audio: str = "audio",
    text: str = "text",
) -> DataFrame:
    """The rows with their skip ``reason``; looks at one row at a time."""
    return df.withColumn("reason", skip_reason_dataset(df, shortest, longest, audio, text))


def has_waveforms(df: DataFrame, audio: str = "audio") -> bool:
    kind = df.schema[audio].dataType if audio in df.columns else None
    return isinstance(kind, T.StructType) and "array" in kind.names


def dataset_waveforms(
    explained: DataFrame,
    audio_dir: str,
    audio: str = "audio",
    text: str = "text",
    language_tag: str | None = None,
    prefix_split: bool = False,
) -> DataFrame:
    """Rows at 16 kHz: ``row_idx, split, audio_filepath, text, duration, wav, reason``.

    Files are named after the source position, so skipped rows leave gaps. Waveforms of skipped
    rows are dropped before any Python function sees them. Where the schema alone decides the
    reason, because there is no waveform column, all rows come back without waveform. Embedded files
    of valid rows are decoded; those in a format that is not get the reason ``error``.
    """
    spoken = manifest_text(guard_text(explained, text), language_tag=language_tag)
    valid = explained.withColumn("_text", spoken)
    if audio in explained.columns and is_embedded(explained.schema[audio].dataType):
        files = F.when(F.col("reason").isNull(), F.col(audio)["bytes"])
        waves = resampled_wavs(valid.withColumn(audio, decoded_audio(files)), audio).withColumn(
            "reason", F.coalesce("reason", F.when(F.col(audio)["array"].isNull(), "error")))
    elif has_waveforms(explained, audio):
        waves = resampled_wavs(valid.withColumn(audio, F.when(F.col("reason").isNull(), F.col(audio))), audio)
    else:
        waves = valid.withColumn("wav", F.lit(None).cast("binary")).withColumn("duration", F.lit(None).cast("double"))
    name = name_audio_file(F.col("row_idx"), F.col("split") if prefix_split else None)
    return waves.select(
        "row_idx",
        "split",
        F.concat_ws("/", F.lit(audio_dir.rstrip("/")), "split", name).alias("audio_filepath"),
        F.col("_text").alias("text"),
        "duration",
        "wav",
        "reason",
    )


def prepare_dataset_corpus(
    df: DataFrame,
    out: str,
    audio_dir: str | None = None,
    max_samples: int | None = None,
    audio: str = "audio",
    text: str = "text",
    language_tag: str | None = None,
    shortest: float = 0.1,
    longest: float = 20.0,
    prefix_split: bool = False,
    save_files: bool = False,
    splits: tuple[str, ...] = ("train", "val"),
) -> dict[str, DataFrame]:
    """Manifests below ``out/manifests`` and the encoded waveforms below ``out/audio_table``.

    The dataset is read once: the audio table keeps every source row with its skip reason, and a
    WAV for the valid ones. Manifests, summaries and single WAV files (on request) come from it.
    ``max_samples`` limits the source rows of each split.
    """
    explained = explain_dataset(first_n(df, max_samples), shortest, longest, audio, text)
    audio_dir = audio_dir or f"{out}/audio"
    waves = dataset_waveforms(explained, audio_dir, audio, text, language_tag, prefix_split)
    table = written_at(
        waves.select("row_idx", "split", "audio_filepath", "text", "duration", "reason", "wav"),
        f"{out}/audio_table",
    )
    if save_files:
        export_audio_files(table.where(F.col("reason").isNull()))
    manifest = to_manifest(table, "split")
    write_manifest(manifest, f"{out}/manifests", splits)
    return {"skipped": skip_summary(table, "split"), "splits": split_summary(manifest)}
