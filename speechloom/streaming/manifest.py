"""Dataset preparation as a stream; all it remembers are the rows that a limit has let through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from speechloom.operators.ladders import to_manifest
from speechloom.operators.splits import hash_split
from speechloom.operators.waveforms import export_audio_files
from speechloom.plans.dataset_corpus import dataset_waveforms, explain_dataset
from speechloom.sources.datasets import first_n
from speechloom.workspace import path_exists


def audio_rows(
    rows: DataFrame,
    audio_dir: str,
    val_fraction: float = 0.1,
    seed: int = 42,
    max_samples: int | None = None,
    shortest: float = 0.1,
    longest: float = 20.0,
    audio: str = "audio",
    text: str = "text",
    language_tag: str | None = None,
) -> DataFrame:
    """Audio table of a batch or streaming dataset with ``row_idx``; each row on its own.

    ``row_idx, split, audio_filepath, text, duration, reason, wav``: every source row with its skip
    reason, and a WAV for the valid ones. Without a ``split`` column, rows are split by hash.
    """
    rows = first_n(rows, max_samples)
    if "split" not in rows.columns:
        rows = hash_split(rows, val_fraction, seed)
    explained = explain_dataset(rows, shortest, longest, audio, text)
    waves = dataset_waveforms(explained, audio_dir, audio, text, language_tag)
    return waves.select("row_idx", "split", "audio_filepath", "text", "duration", "reason", "wav")


def manifest_rows(rows: DataFrame, audio_dir: str, **options) -> DataFrame:
    """Manifest rows of a batch or streaming dataset with ``row_idx``."""
    return to_manifest(audio_rows(rows, audio_dir, **options), "row_idx", "split")


LIMITS = "split string, kept bigint"


def first_of_batch(batch: DataFrame, n: int, limits: str, number: int) -> DataFrame:
    """Of a batch the rows that ``first_n`` would keep, after those that earlier batches kept.

    ``limits`` is a folder with one small table per batch, the rows kept of each split. Only those of
    earlier batches are read and the batch's own is written anew, so a repeated batch, also after a
    restart, keeps the same rows. A row that comes late, but at a position below ``n``, is kept as well.
    Each task passes on ``n`` ids per split at most.
    """
    spark = batch.sparkSession
    split = F.col("split") if "split" in batch.columns else F.lit("")
    ids = batch.select(F.coalesce(split, F.lit("")).alias("_split"), F.col("row_idx").alias("_row"))
    place = F.row_number().over(Window.partitionBy("_split").orderBy("_row"))
    ranked = ids.withColumn("_place", place).where(F.col("_place") <= n)
    if path_exists(spark, limits):
        before = spark.read.option("basePath", limits).schema(f"{LIMITS}, batch bigint").parquet(limits)
        # one row per split
        kept = before.where(F.col("batch") < number).groupBy(F.col("split").alias("_split")).agg(F.sum("kept").alias("_kept"))
        room = n - F.coalesce("_kept", F.lit(0))
        # no more rows than its position come before a row, so one below n is always among the first
        ranked = ranked.join(kept, "_split", "left").where((F.col("_place") <= room) | (F.col("_row") < n))
    own = f"{limits}/batch={number}"
    ranked.groupBy("_split").agg(F.max("_row").alias("_last"), F.count("*").alias("kept")).withColumnRenamed(
        "_split", "split").write.mode("overwrite").parquet(own)
    last = spark.read.schema(f"{LIMITS}, _last bigint").parquet(own).select(F.col("split").alias("_split"), "_last")
    rows = batch.withColumn("_key", F.coalesce(split, F.lit(""))).join(last, F.col("_key") == F.col("_split"))
    return rows.where(F.col("row_idx") <= F.col("_last")).select(*batch.columns)


def stream_manifest(
    rows: DataFrame, out: str, checkpoint: str, audio_dir: str, save_files: bool = False,
    max_samples: int | None = None, **options
) -> StreamingQuery:
    """Audio table and manifest of what a streaming source holds now; a restart adds only new rows.

    Each batch of the stream writes ``out/audio_table/batch=N``, and from that table its manifest
    ``out/manifest/batch=N`` and, on request, single WAV files; a repeated batch replaces its own.
    ``max_samples`` limits the source rows of each split to the first by batch and then by position,
    whatever the positions; where later batches hold later positions, that is what ``first_n`` keeps.
    """

    def store(batch: DataFrame, number: int) -> None:
        if max_samples:
            batch = first_of_batch(batch, max_samples, f"{out}/limits", number)
        batch = audio_rows(batch, audio_dir, **options)
        table = f"{out}/audio_table/batch={number}"
        batch.write.mode("overwrite").parquet(table)
        kept = batch.sparkSession.read.schema(batch.schema).parquet(table)
        if save_files:
            export_audio_files(kept.where(F.col("reason").isNull()))
        (
            to_manifest(kept, "row_idx", "split").write.mode("overwrite").option("ignoreNullFields", False)
            .partitionBy("split").json(f"{out}/manifest/batch={number}")
        )

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
