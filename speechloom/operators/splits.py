"""Train/validation splits, ordering, sampling and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 4  # hex digits looked at per pass: 65,536 groups at most


def shuffle_key(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def split_cut(df: DataFrame, fraction: float, seed: int, row_id: str = "row_idx") -> str | None:
    """Shortest hash prefix P such that exactly floor(n * fraction) rows hash to P or below.

    The k-th smallest hash is found digit by digit: each pass counts the next four hex digits
    inside the group that holds the cut, so it neither sorts nor ranks, and a pass returns at most
    65,536 counts. ``row_id`` must be unique.
    """
    hashes = df.select(shuffle_key(F.col(row_id), seed).alias("h"))
    prefix, wanted = "", None
    while True:
        digits = F.substring("h", len(prefix) + 1, DIGITS)
        inside = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        counts = sorted((r["d"], r["count"]) for r in inside.groupBy(digits.alias("d")).count().collect())
        if wanted is None:
            wanted = int(sum(c for _, c in counts) * fraction)
            if wanted == 0:
                return None
        for group, size in counts:
            if wanted <= size:
                break
            wanted -= size
        prefix += group
        if wanted == size:
            return prefix
        if len(prefix) == 32:
            raise ValueError(f"{row_id} is not unique, so the split cannot be exact")


def exact_split(
    df: DataFrame, fraction: float, seed: int = 42, row_id: str = "row_idx", cut_from: DataFrame | None = None
) -> DataFrame:
    """Add ``split``: floor(n * fraction) rows in seeded random order are val, the others train.

    ``cut_from`` may give a cheaper table with the same row ids to find the cut in.
    """
    cut = split_cut(cut_from if cut_from is not None else df, fraction, seed, row_id)
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    is_val = F.substring(shuffle_key(F.col(row_id), seed), 1, len(cut)) <= cut
    return df.withColumn("split", F.when(is_val, "val").otherwise("train"))


def hash_split(df: DataFrame, fraction: float, seed: int = 42, row_id: str = "row_idx") -> DataFrame:
    """Approximate split that looks at one row at a time, so it also works on streams."""
    unit = F.conv(F.substring(shuffle_key(F.col(row_id), seed), 1, 8), 16, 10).cast("double") / 4294967296.0
    return df.withColumn("split", F.when(unit < fraction, "val").otherwise("train"))


def shuffle_rows(df: DataFrame, seed: int = 42, row_id: str = "row_idx") -> DataFrame:
    """Seeded random order; a range-partitioned sort."""
    return df.orderBy(shuffle_key(F.col(row_id), seed), row_id)


def preview(df: DataFrame, n: int = 5, row_id: str = "row_idx") -> DataFrame:
    """First few rows in source order."""
    return df.orderBy(row_id).limit(n)


def dataset_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def split_summary(df: DataFrame) -> DataFrame:
    """Entries and total duration per split, summed over rounded durations in whole milliseconds."""
    milliseconds = F.round(F.col("duration") * 1000).cast("bigint")
    return (
        df.groupBy("split")
        .agg(F.count("*").alias("entries"), F.sum(milliseconds).alias("total_ms"))
        .withColumn("hours", F.format_string("%.2f", F.col("total_ms") / 3600000.0))
    )
