"""Joins between transcripts, audio files and hypotheses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 65536


def join_audio_files(
    transcripts: DataFrame,
    files: DataFrame,
    path: str = "audio_filepath",
    row_id: str = "row_idx",
    hot_rows: int = 1_000_000,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Left join of transcripts with ``files(path, measured)``; adds ``found``.

    A path listed several times counts once, with its longest duration.

    Many transcripts may name one file. Paths are counted in hash buckets first, which moves at
    most 65,536 rows; buckets far above the average are salted by row id on the transcript side and
    their few files repeated, so no task receives a whole hot path. Without hot buckets this is a
    plain join and Spark picks the strategy. ``sizes_from`` may give a cheaper table with at least
    these paths to count in.
    """
    listed = files.groupBy(F.col("path").alias(path)).agg(F.max("measured").alias("measured"), F.lit(True).alias("_listed"))
    transcripts, listed, keys = _salted(transcripts, listed, path, row_id, hot_rows, sizes_from)
    joined = transcripts.join(listed, keys, "left")
    return joined.withColumn("found", F.coalesce("_listed", F.lit(False))).drop("_listed", "_salt")


def _salted(transcripts, listed, path, row_id, hot_rows, sizes_from=None):
    """Both sides and the join keys; with a salt column where some bucket of paths is hot."""
    salts = _hot_bucket_salts(transcripts if sizes_from is None else sizes_from, path, hot_rows)
    if not salts:
        return transcripts, listed, [path]
    # at most one entry per bucket, so the table cannot exceed 65,536 rows
    hot = F.broadcast(transcripts.sparkSession.createDataFrame(salts, "_bucket int, _salts int"))
    transcripts = (
        transcripts.withColumn("_bucket", _bucket(path))
        .join(hot, "_bucket", "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(row_id), "_salts"), F.lit(0)).cast("int"))
        .drop("_bucket", "_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    listed = (
        listed.withColumn("_bucket", _bucket(path))
        .join(hot, "_bucket", "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_bucket", "_salts")
    )
    return transcripts, listed, [path, "_salt"]


def _bucket(path: str):
    return F.pmod(F.xxhash64(path), F.lit(BUCKETS)).cast("int")


def _hot_bucket_salts(df: DataFrame, path: str, hot_rows: int) -> list[tuple[int, int]]:
    counts = df.groupBy(_bucket(path).alias("b")).count().collect()
    total = sum(r["count"] for r in counts)
    share = max(hot_rows, 8 * total // BUCKETS)
    return [(r["b"], -(-r["count"] // share)) for r in counts if r["count"] > share]


def missing_audio(
    transcripts: DataFrame,
    files: DataFrame,
    path: str = "audio_filepath",
    row_id: str = "row_idx",
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Transcripts whose file is not listed; hot paths are salted as above."""
    listed = files.select(F.col("path").alias(path))
    transcripts, listed, keys = _salted(transcripts, listed, path, row_id, hot_rows)
    return transcripts.join(listed, keys, "left_anti").drop("_salt")


def pair_hypotheses(
    references: DataFrame, hypotheses: DataFrame, key: str = "row_idx", keep_missing: bool = False
) -> DataFrame:
    """References with their hypotheses by row id; unmatched references only on request."""
    return references.join(
        hypotheses.select(key, "hypothesis"), key, "left" if keep_missing else "inner"
    )
