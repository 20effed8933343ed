"""Waveform jobs: resampling, WAV encoding and export."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechloom.functions.waveform import (
    UnreadableAudio,
    encode_wav,
    fourier_resample,
    pcm16,
    resampled_blocks,
    resampled_length,
    wav_head,
    wav_layout,
    wav_samples,
)
from speechloom.operators.ladders import within_duration
from speechloom.schema import TARGET_RATE
from speechloom.sources.audio_files import default_fs, file_opener, probed_files

SLICE_BYTES = 4 << 20

_RESAMPLED_FILE = T.StructType([
    T.StructField("wav", T.BinaryType()),
    T.StructField("duration", T.DoubleType()),
])


def _rows(arrays: pa.Array):
    """Each list of an Arrow list column as a numpy view, None for NULL."""
    values = arrays.values.to_numpy(zero_copy_only=False)
    offsets = arrays.offsets.to_numpy()
    valid = arrays.is_valid().to_numpy(zero_copy_only=False)
    for i, ok in enumerate(valid):
        yield values[offsets[i] : offsets[i + 1]] if ok else None


def _in_slices(rows: Iterable, kind: pa.DataType, size: Callable[[object], int]) -> Iterator[pa.Array]:
    """Rows as Arrow arrays of bounded bytes: resampling can make a batch much larger than its input."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 0 if row is None else size(row)
        if weight >= SLICE_BYTES:
            yield pa.array(held, kind)
            held, weight = [], 0
    if held:
        yield pa.array(held, kind)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _resampled(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def rows():
        for arrays, rates in batches:
            for x, rate in zip(_rows(arrays), rates.to_pylist()):
                if x is None:
                    yield None
                else:
                    n_out = resampled_length(len(x), rate, TARGET_RATE)
                    yield fourier_resample(x, n_out).astype(np.float32)

    return _in_slices(rows(), pa.list_(pa.float32()), lambda x: x.nbytes)


def resampled_duration(n_samples: Column, rate: Column) -> Column:
    """Seconds at 16 kHz; the new length is known from the old one, so no samples are needed."""
    new_length = F.ceil(n_samples.cast("double") * TARGET_RATE / rate.cast("double"))
    return new_length.cast("double") / TARGET_RATE


def resample_waveforms(df: DataFrame, audio: str = "audio") -> DataFrame:
    """Waveforms at 16 kHz with their new ``duration``.

    Filter first: rows must have a positive rate; without such a field it is 16 kHz. Rows already at
    16 kHz never leave the JVM, and nothing does when only the duration is selected afterwards.
    """
    array = F.col(audio)["array"].cast("array<float>")
    given = "sampling_rate" in df.schema[audio].dataType.names
    rate = F.col(audio)["sampling_rate"] if given else F.lit(TARGET_RATE)
    other = rate != TARGET_RATE
    changed = _resampled(F.when(other, array), F.when(other, rate))
    return (
        df.withColumn("_array", F.when(other, changed).otherwise(array))
        .withColumn("duration", resampled_duration(F.size(array), rate))
        .withColumn(
            audio,
            F.struct(F.col("_array").alias("array"), F.lit(TARGET_RATE).alias("sampling_rate")),
        )
        .drop("_array")
    )


@F.arrow_udf(T.BinaryType())
def _encoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    rows = (None if x is None else encode_wav(x, rate)
            for arrays, rates in batches for x, rate in zip(_rows(arrays), rates.to_pylist()))
    return _in_slices(rows, pa.binary(), len)


def encoded_wav(audio: Column) -> Column:
    return _encoded(audio["array"], audio["sampling_rate"])


@F.arrow_udf(T.BinaryType())
def _resampled_wav(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def rows():
        for arrays, rates in batches:
            for x, rate in zip(_rows(arrays), rates.to_pylist()):
                if x is None:
                    yield None
                else:
                    y = fourier_resample(x, resampled_length(len(x), rate, TARGET_RATE))
                    yield encode_wav(y.astype(np.float32), TARGET_RATE)

    return _in_slices(rows(), pa.binary(), len)


def resampled_wavs(df: DataFrame, audio: str = "audio") -> DataFrame:
    """``wav`` and ``duration`` of the waveforms at 16 kHz; rows as for ``resample_waveforms``.

    The samples at 16 kHz, which may be many more, stay in one Python function, one row at a time.
    """
    array = F.col(audio)["array"].cast("array<float>")
    given = "sampling_rate" in df.schema[audio].dataType.names
    rate = F.coalesce(F.col(audio)["sampling_rate"], F.lit(TARGET_RATE)) if given else F.lit(TARGET_RATE)
    seconds = resampled_duration(F.size(array), F.col(audio)["sampling_rate"] if given else rate)
    return df.withColumn("wav", _resampled_wav(array, rate)).withColumn("duration", seconds)


def _resample_content(content: pa.Scalar) -> dict | None:
    if not content.is_valid:
        return None
    try:
        x, rate = wav_samples(content.as_buffer())
    except UnreadableAudio:
        return None
    n_out = resampled_length(len(x), rate, TARGET_RATE)
    wav = encode_wav(fourier_resample(x, n_out), TARGET_RATE)
    return {"wav": wav, "duration": n_out / TARGET_RATE}


@F.arrow_udf(_RESAMPLED_FILE)
def _resampled_file(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    rows = (_resample_content(content) for contents in batches for content in contents)
    kind = pa.struct([("wav", pa.binary()), ("duration", pa.float64())])
    return _in_slices(rows, kind, lambda row: len(row["wav"]))


def resample_files(files: DataFrame, *more: Column) -> DataFrame:
    """``path, wav, measured`` of a table with ``content``: mono 16 kHz PCM; NULLs when it cannot be read.

    ``more`` columns of the files follow. A file may get thousands of times longer, so take what is
    needed of ``wav`` before a join or another shuffle.
    """
    done = files.select("path", _resampled_file(F.col("content")).alias("_r"), *more)
    return done.select("path", F.col("_r.wav").alias("wav"), F.col("_r.duration").alias("measured"), *done.columns[2:])


def resample_to_files(files: DataFrame) -> DataFrame:
    """Write mono 16 kHz copies of ``files(path, length, target)``; ``path, target, measured``, once run.

    Tasks open the files themselves and go through them in blocks, so files may have any size; each
    copy is written once, under a temporary name until it is whole. ``measured`` is NULL, and nothing
    is written, where a file cannot be read.
    """
    default = default_fs(files.sparkSession)

    def run(batches):
        opened, made = file_opener(default), set()
        for batch in batches:
            seconds = []
            for path, length, target in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "target"))):
                client, name = opened(path)
                with client.open_input_file(name) as stream:
                    try:
                        layout = wav_layout(stream, length)
                        n = resampled_length(layout["length"] // layout["block"], layout["rate"], TARGET_RATE)
                        blocks = resampled_blocks(stream, layout, TARGET_RATE)
                        first = next(blocks, np.zeros(0))
                    except (ValueError, struct.error):
                        seconds.append(None)
                        continue
                    parts = (pcm16(x) for part in ([first], blocks) for x in part)
                    _write_whole(opened, target, [wav_head(n, TARGET_RATE)], parts, made)
                seconds.append(n / TARGET_RATE)
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("target"), pa.array(seconds, pa.float64())],
                ["path", "target", "measured"])

    return files.select("path", "length", "target").mapInArrow(run, "path string, target string, measured double")


def _write_whole(opened: Callable, path: str, *parts) -> None:
    """Write the parts under a temporary name and rename it, so that no other task sees or tears half a file."""
    *chunks, made = parts
    client, name = opened(path)
    folder, _, last = name.rpartition("/")
    if folder not in made:
        client.create_dir(folder, recursive=True)
        made.add(folder)
    partial = f"{folder}/.{last}.{uuid.uuid4().hex}.tmp"
    with client.open_output_stream(partial) as stream:
        for chunk in chunks:
            for piece in chunk:
                stream.write(piece)
    client.move(partial, name)


def validate_audio_table(files: DataFrame, shortest: float, longest: float) -> DataFrame:
    """``path, ok, duration, reason`` per listed file."""
    probed = probed_files(files).withColumnRenamed("measured", "duration")
    reason = (
        F.when(F.col("duration").isNull(), "read_error")
        .when(F.col("duration") < shortest, "too_short")
        .when(F.col("duration") > longest, "too_long")
    )
    ok = F.coalesce(within_duration(F.col("duration"), shortest, longest), F.lit(False))
    return probed.select("path", ok.alias("ok"), "duration", reason.alias("reason"))


def export_audio(df: DataFrame, path: str, audio: str = "audio") -> None:
    """Table of ``audio_filepath, wav``: one Parquet row per waveform instead of one small file."""
    df.select("audio_filepath", encoded_wav(F.col(audio)).alias("wav")).write.parquet(path)


def export_audio_files(wavs: DataFrame) -> None:
    """Write each ``wav`` of a table to its own ``audio_filepath``, from the tasks.

    The paths must be on a file system that all executors share; without a scheme they are on the
    cluster's default one. A retried task writes the same bytes again.
    """
    default = default_fs(wavs.sparkSession)

    def write(batches):
        opened, made = file_opener(default), set()
        for batch in batches:
            for path, wav in zip(batch.column("audio_filepath").to_pylist(), batch.column("wav")):
                _write_whole(opened, path, [wav.as_buffer()], made)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    wavs.select("audio_filepath", "wav").mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()
