"""Dataset splits with embedded waveforms."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def read_dataset_split(
    spark: SparkSession, path: str, split: str, max_samples: int | None = None, required: bool = False
) -> DataFrame | None:
    """Rows of one split. A split that cannot be loaded is None with a warning, unless required."""
    try:
        df = spark.read.parquet(path).where(F.col("split") == split)
    except AnalysisException as e:
        if required:
            raise
        warnings.warn(f"could not load split '{split}': {e}", stacklevel=2)
        return None
    df = first_n(df, max_samples)
    if df.isEmpty():
        if required:
            raise ValueError(f"split '{split}' has no rows in {path}")
        warnings.warn(f"split '{split}' has no rows in {path}", stacklevel=2)
        return None
    return df


def first_n(df: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` source rows of each split by position, before any filtering; 0 or None keeps all.

    Positions need not start at 0 or be without gaps. Only ids are ranked, and each task passes on
    ``n`` per split at most. In a stream, where rows can't be ranked, positions must count from 0 in
    each split.
    """
    if not n:
        return df
    if df.isStreaming:
        return df.where(F.col("row_idx") < n)
    split = F.col("split") if "split" in df.columns else F.lit("")
    ids = df.select(split.alias("_split"), F.col("row_idx").alias("_row"))
    place = F.row_number().over(Window.partitionBy("_split").orderBy("_row"))
    last = ids.withColumn("_place", place).where(F.col("_place") <= n).groupBy("_split").agg(F.max("_row").alias("_last"))
    return df.join(last, split.eqNullSafe(F.col("_split"))).where(F.col("row_idx") <= F.col("_last")).select(*df.columns)
