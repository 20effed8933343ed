"""Audio files embedded in dataset rows: ``struct<bytes binary, path string>`` instead of samples.

Durations come from the two ends of a file, so that the filter runs before any file is decoded, and
the whole bytes reach Python only for the few files whose ends don't tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechloom.functions.waveform import (
    OGG_PAGE,
    Ends,
    OutOfReach,
    UnreadableAudio,
    audio_duration,
    wav_samples,
)
from speechloom.schema import WAVEFORM

HEAD_BYTES = 4096
SLICE_BYTES = 4 << 20


def is_embedded(kind: T.DataType) -> bool:
    """Whether a column of this type holds encoded files rather than samples."""
    return isinstance(kind, T.StructType) and "array" not in kind.names and "bytes" in kind.names


@F.arrow_udf(T.DoubleType())
def _from_ends(head: pa.Array, tail: pa.Array, size: pa.Array) -> pa.Array:
    """Seconds; NULL for an unreadable file, NaN where its ends don't tell."""
    out: list[float | None] = []
    for h, t, n in zip(head.to_pylist(), tail.to_pylist(), size.to_pylist()):
        try:
            out.append(None if n is None else audio_duration(Ends(h, t or b"", n), n))
        except OutOfReach:
            out.append(float("nan"))
    return pa.array(out, pa.float64())


@F.arrow_udf(T.DoubleType())
def _from_all(content: pa.Array) -> pa.Array:
    out = [audio_duration(pa.BufferReader(c.as_buffer()), c.as_buffer().size) if c.is_valid else None for c in content]
    return pa.array(out, pa.float64())


def embedded_duration(content: Column) -> Column:
    """Seconds of a WAV, FLAC, Ogg or MPEG file given as bytes; NULL for NULL and unreadable ones."""
    ogg = F.substring(content, 1, 4) == F.lit(bytearray(b"OggS"))
    tail = F.when(ogg, F.substring(content, -OGG_PAGE, OGG_PAGE))
    seconds = _from_ends(F.substring(content, 1, HEAD_BYTES), tail, F.octet_length(content))
    return F.when(F.isnan(seconds), _from_all(F.when(F.isnan(seconds), content))).otherwise(seconds)


@F.arrow_udf(WAVEFORM)
def _decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("array", pa.list_(pa.float32())), ("sampling_rate", pa.int32())])
    for content in batches:
        held, weight = [], 0
        for c in content:
            try:
                x, rate = wav_samples(c.as_buffer()) if c.is_valid else (None, None)
            except UnreadableAudio:
                x, rate = None, None
            held.append(None if x is None else {"array": x.astype(np.float32), "sampling_rate": rate})
            weight += 0 if x is None else 4 * len(x)
            if weight >= SLICE_BYTES:
                yield pa.array(held, kind)
                held, weight = [], 0
        if held:
            yield pa.array(held, kind)


def decoded_audio(content: Column) -> Column:
    """Samples and rate of a WAV file given as bytes; NULL for NULL, unreadable ones and other formats."""
    return _decoded(content)
