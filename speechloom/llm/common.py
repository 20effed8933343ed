"""Helpers of the operators: whole texts in bounded slices, and words as hashes."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from speechloom.workspace import discard, fresh_dir, written_at

SLICE_BYTES = 4 << 20

# The white space that ends a word.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, purpose: str, done: tuple[DataFrame, ...] = (), codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder; what only served to make it is let go.

    ``done`` names settled tables that nothing reads from now on.
    """
    path = fresh_dir(df.sparkSession, purpose)
    if codec:
        df.write.option("compression", codec).parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
    else:
        out = written_at(df, path)
    out._settled = path
    let_go(df.sparkSession, done)
    return out


def let_go(spark: SparkSession, done: tuple[DataFrame, ...] = ()) -> None:
    """Remove settled tables that nothing reads any more, and shuffle files of jobs that are over.

    Spark removes the latter once the driver's JVM has noticed that nothing refers to them.
    """
    for table_ in done:
        discard(spark, table_._settled)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def process_cache(key: str, build: Callable):
    """A value built once per Python process; functions sent by value have new globals in each task."""
    kept = sys.__dict__.setdefault("_speechloom_kept", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes, or one longer value."""
    for batch in batches:
        values = batch.column(column)
        if not len(values):
            continue
        offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4).astype(np.int64)
        at = 0
        while at < len(values):
            end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            end = min(max(end, at + 1), len(values))
            yield batch.slice(at, end - at)
            at = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, nulls as empty texts, and where each text begins and the last ends."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and for each text the number of its first word (and an end)."""
    n_texts = len(offsets) - 1
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n_texts + 1, np.int64)
    space = _IS_SPACE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    first = np.flatnonzero(before & ~space)
    end = np.flatnonzero(after & ~space) + 1
    return first, end, np.searchsorted(first, offsets).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


LONG_WORD = 512  # bytes from which a word is hashed by itself


class WordHasher:
    """64-bit hashes of all words of a slice at once, eight bytes of every word at a time.

    Each step mixes the bytes into what came before, so that no sum over places makes words equal.
    """

    def __init__(self, seed: int, lower: bool = False):
        self.seed, self.factor = np.random.default_rng(seed).integers(1, 1 << 63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.case = np.arange(256, dtype=np.uint8)
        if lower:
            self.case[65:91] = self.case[97:123]

    def __call__(self, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.empty(0, np.uint64)
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[:len(data)] = self.case[data]
        eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        size = end - first
        out = mixed(size.astype(np.uint64) * self.factor + self.seed)
        for i in np.flatnonzero(size > LONG_WORD):
            out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(padded[first[i]:end[i]].tobytes(), int(self.seed)))
        word = np.flatnonzero(size <= LONG_WORD)
        at, left = first[word], size[word]
        while len(word):
            part = eight[at]
            short = left < 8
            part[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
            out[word] = mixed((out[word] ^ part) * self.factor)
            more = left > 8
            word, at, left = word[more], at[more] + 8, left[more] - 8
        return out


def windows(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values; runs over text ends are up to the caller."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = np.random.default_rng(seed).integers(1, 1 << 63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = hashes[:n] * factors[0]
    for i in range(1, width):
        out += hashes[i:n + i] * factors[i]
    return mixed(out)
