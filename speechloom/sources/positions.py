"""Source positions for tables that have no row index of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speechloom.workspace import written


def with_row_idx(df: DataFrame) -> DataFrame:
    """Add ``row_idx``, the 0-based position over the files in path order.

    ``df`` must come straight from a file source. The rows are written once with their file block
    and place inside it; only one row per file block takes part in the running sum.
    """
    block = ["_file", "_block"]
    staged = written(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        ),
        "positions",
    )
    sizes = staged.groupBy(*block).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    # one row per file block; written, so that Spark knows whether it is small enough to go to all rows
    offsets = written(
        sizes.select(*block, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "offsets"
    )
    row_idx = (F.col("_offset") + F.col("_place") - F.col("_first")).alias("row_idx")
    return staged.join(offsets, block).select(row_idx, *df.columns)
