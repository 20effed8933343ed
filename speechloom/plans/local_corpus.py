"""Transcript table and audio files to a split manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.functions.paths import resampled_path, resolve_audio_path
from speechloom.functions.text import (
    append_language_tag,
    normalize_text,
    normalizes_to_nothing,
    strip_text,
)
from speechloom.operators.joins import join_audio_files
from speechloom.operators.ladders import (
    parse_duration,
    skip_reason_local,
    skip_reason_local_resampled,
    skip_summary,
    to_manifest,
)
from speechloom.operators.splits import exact_split, shuffle_key, split_summary
from speechloom.operators.waveforms import resample_to_files
from speechloom.sources.audio_files import default_fs
from speechloom.sources.manifests import write_manifest
from speechloom.workspace import written


def explain_transcripts(
    transcripts: DataFrame,
    files: DataFrame,
    shortest: float = 0.1,
    longest: float = 20.0,
    base_dir: str | None = None,
    normalize: bool = False,
    keep_marks: bool = False,
    language_tag: str | None = None,
    resampled: bool = False,
    working_dir: str | None = None,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """``row_idx, audio_filepath, text, duration, reason`` for every transcript row.

    ``transcripts`` has ``row_idx, audio, text, duration`` (duration as text), ``files`` has
    ``path, measured``. Rows that need no file, because their text or path is empty, go through the
    join with a key of their own. Texts of valid rows are normalised and tagged, after the join;
    others are as given.
    """
    rows = transcripts.select(
        "row_idx",
        resolve_audio_path(
            F.col("audio"), base_dir, working_dir, default_fs(transcripts.sparkSession)
        ).alias("audio_filepath"),
        strip_text(F.col("text")).alias("text"),
        parse_duration(F.col("duration")).alias("supplied"),
        (F.coalesce(F.col("audio"), F.lit("")) != "").alias("named"),
    )
    spoken_of = F.coalesce(F.col("text"), F.lit("")) != ""
    needs_file = spoken_of & F.col("named")
    key = F.when(needs_file, F.col("audio_filepath")).otherwise(F.concat(F.lit("\0"), "row_idx"))
    joined = join_audio_files(
        rows.withColumn("_path", key), files, path="_path", hot_rows=hot_rows,
        sizes_from=rows.where("named").select(F.col("audio_filepath").alias("_path")),
    ).withColumn("duration", F.when(needs_file, F.coalesce("supplied", "measured")))
    measured, duration, text = F.col("measured"), F.col("duration"), F.col("text")
    nothing_left = normalizes_to_nothing(text, keep_marks) if normalize else None
    if resampled:
        reason = skip_reason_local_resampled(
            measured, duration, shortest, longest, nothing_left=nothing_left
        )
    else:
        reason = skip_reason_local(
            F.col("found"), measured, duration, shortest, longest, nothing_left=nothing_left
        )
    reason = F.when(~spoken_of, "empty_text").when(~F.col("named"), "read_error").otherwise(reason)
    spoken = append_language_tag(normalize_text(text, keep_marks) if normalize else text, language_tag)
    return joined.withColumn("reason", reason).select(
        "row_idx",
        "audio_filepath",
        F.when(F.col("reason").isNull(), spoken).otherwise(text).alias("text"),
        "duration",
        "reason",
    )


def named_files(transcripts: DataFrame, files: DataFrame, base_dir: str | None, working_dir: str | None) -> DataFrame:
    """The files that a transcript with a text names, each once."""
    path = resolve_audio_path(F.col("audio"), base_dir, working_dir, default_fs(transcripts.sparkSession))
    named = transcripts.where((F.col("audio") != "") & (strip_text(F.col("text")) != "")).select(path.alias("path"))
    return files.select("path", "length").dropDuplicates(["path"]).join(named.distinct(), "path", "left_semi")


def resample_corpus_files(
    files: DataFrame, resample_dir: str, base_dir: str | None = None, working_dir: str | None = None
) -> DataFrame:
    """Write mono 16 kHz copies of ``files(path, length)``; ``path, target, measured``."""
    fs = default_fs(files.sparkSession)
    target = resampled_path(F.col("path"), resample_dir, base_dir, working_dir, fs)
    targets = written(files.select("path", "length", target.alias("target")), "targets")
    clash = targets.groupBy("target").count().where(F.col("count") > 1).limit(1).collect()
    if clash:
        raise ValueError(f"several files would be written to {clash[0]['target']}")
    return written(resample_to_files(targets), "resampled")


def prepare_local_corpus(
    transcripts: DataFrame,
    files: DataFrame,
    out: str,
    val_fraction: float = 0.1,
    seed: int = 42,
    resample_dir: str | None = None,
    base_dir: str | None = None,
    strict: bool = True,
    **options,
) -> dict[str, DataFrame]:
    """Write the split manifest below ``out``; returns the ``skipped`` and ``splits`` summaries.

    With ``resample_dir``, ``files`` is a listing with ``length``; the files that transcripts name are
    resampled, and the manifest names the copies. Each split is written in shuffled order.
    """
    working_dir = options.get("working_dir")
    if resample_dir:
        files = named_files(transcripts, files, base_dir, working_dir)
        files = resample_corpus_files(files, resample_dir, base_dir, working_dir)
    explained = explain_transcripts(
        transcripts, files, base_dir=base_dir, resampled=bool(resample_dir), **options
    )
    if resample_dir:
        fs = default_fs(transcripts.sparkSession)
        target = resampled_path(F.col("audio_filepath"), resample_dir, base_dir, working_dir, fs)
        explained = explained.withColumn("audio_filepath", target)
    explained = written(explained, "explained")
    valid = to_manifest(explained, "row_idx")
    if strict and valid.isEmpty():
        raise ValueError("no valid entries found")
    split = exact_split(valid, val_fraction, seed)
    write_manifest(split.orderBy("split", shuffle_key(F.col("row_idx"), seed), "row_idx"), out)
    return {"skipped": skip_summary(explained), "splits": split_summary(split)}
