"""Manifest or directory to transcriptions and error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.operators.error_rates import corpus_error_rates
from speechloom.operators.scoring import ScorerFactory, sample_record, spread, spread_seconds, transcribe
from speechloom.schema import AUDIO_EXTENSIONS
from speechloom.sources.audio_files import scan_audio_dir
from speechloom.workspace import written

BYTES_PER_SECOND = 32_000  # of 16-bit samples at 16 kHz; only the proportion of files matters


def transcribe_directory(
    spark: SparkSession,
    path: str,
    make_scorer: ScorerFactory,
    extensions: tuple[str, ...] | list[str] = AUDIO_EXTENSIONS,
    batch_size: int = 8,
    rows_per_task: int = 2000,
) -> DataFrame:
    """``path, transcription`` of every audio file below ``path``; tasks get files of about equal bytes."""
    files = scan_audio_dir(spark, path, extensions).select("path", (F.col("length") / BYTES_PER_SECOND).alias("seconds"))
    even = spread_seconds(files, rows_per_task, "seconds").select("path")
    return transcribe(even, make_scorer, batch_size, source="path")


def evaluate_manifest(
    manifest: DataFrame,
    make_scorer: ScorerFactory,
    batch_size: int = 8,
    strip_tag: bool | str = False,
    rows_per_task: int = 2000,
) -> tuple[DataFrame, DataFrame]:
    """One-row metrics and the samples, with ``row_idx`` if the manifest has it.

    Tasks get about equal seconds where the manifest has durations. Scoring runs once; both are read from its written result.
    """
    even = spread_seconds if "duration" in manifest.columns else spread
    scored = written(
        transcribe(
            even(manifest, rows_per_task), make_scorer, batch_size, output="hypothesis"
        ).withColumnRenamed("text", "reference"),
        "scored",
    )
    position = [c for c in scored.columns if c == "row_idx"]
    return corpus_error_rates(scored, strip_tag), sample_record(scored, *position)
