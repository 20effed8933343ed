"""Limits of a stream hold over batches and restarts, whatever the positions."""

import random

import pytest
from pyspark.sql import functions as F

from speechloom.sources.datasets import first_n
from speechloom.streaming.manifest import first_of_batch, stream_manifest

SCHEMA = "row_idx bigint, audio struct<array: array<float>, sampling_rate: int>, text string, split string"


def rows_of(ids, rng):
    return [(i, ([0.1] * 3200, 16000), f"t{i}", rng.choice(["train", "train", "val"])) for i in ids]


def run(spark, tmp_path, source, **options):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    query = stream_manifest(rows, out, f"{out}/checkpoint", "/audio", max_samples=7, **options)
    query.awaitTermination()
    return spark.read.parquet(f"{out}/audio_table").collect()


def test_stream_equals_batch_across_a_restart(spark, tmp_path):
    rng = random.Random(1)
    ids = sorted(rng.sample(range(10_000), 60))  # with gaps
    parts = [ids[:5], ids[5:9], ids[9:30], ids[30:45], ids[45:]]
    source, everything = str(tmp_path / "in"), []
    for k, part in enumerate(parts):
        if k == 3:
            run(spark, tmp_path, source)  # what is there so far; then a new start
        everything += rows_of(part, rng)
        shuffled = rng.sample(everything[-len(part):], len(part))
        spark.createDataFrame(shuffled, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    got = run(spark, tmp_path, source)
    wanted = first_n(spark.createDataFrame(everything, SCHEMA), 7).collect()
    assert sorted((r["split"], r["row_idx"]) for r in got) == sorted((r["split"], r["row_idx"]) for r in wanted)
    assert len(got) == 14


def test_a_repeated_batch_keeps_the_same_rows(spark, tmp_path):
    rng = random.Random(2)
    limits = str(tmp_path / "limits")
    batches = [spark.createDataFrame(rows_of(range(a, a + 4), rng), SCHEMA).drop("split") for a in (50, 60, 70)]
    first = [sorted(r["row_idx"] for r in first_of_batch(b, 6, limits, k).collect()) for k, b in enumerate(batches)]
    assert first == [[50, 51, 52, 53], [60, 61], []]
    for k in (1, 0, 2):
        again = first_of_batch(batches[k], 6, limits, k).collect()
        assert sorted(r["row_idx"] for r in again) == first[k]
    late = spark.createDataFrame(rows_of([3, 90], rng), SCHEMA).drop("split")
    assert [r["row_idx"] for r in first_of_batch(late, 6, limits, 3).collect()] == [3]


@pytest.mark.parametrize("n", [0, None])
def test_no_limit(spark, tmp_path, n):
    df = spark.createDataFrame(rows_of(range(3), random.Random(3)), SCHEMA)
    assert first_n(df, n).count() == 3
    empty = first_of_batch(df.where(F.lit(False)), 5, str(tmp_path / "l"), 0)
    assert empty.count() == 0
