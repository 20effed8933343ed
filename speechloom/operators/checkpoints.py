"""Best checkpoints of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speechloom.functions.paths import checkpoint_name


def best_checkpoints(
    log: DataFrame, run: str | None = None, keep: int = 5, keep_last: bool = True
) -> DataFrame:
    """The ``keep`` epochs with the lowest ``val_wer`` plus the last epoch, per run if one is given.

    Rank limits are applied before the shuffle, so a run of any length sends a few rows per task.
    """
    key = [run] if run else []
    if run:
        best = _lowest(log, run, keep, F.col("val_wer"), F.col("epoch"))
        last = _lowest(log, run, 1, F.col("epoch").desc(), F.col("val_wer"))
    else:
        best = log.orderBy("val_wer", "epoch").limit(keep)
        last = log.orderBy(F.col("epoch").desc(), "val_wer").limit(1)
    kept = best.unionByName(last).dropDuplicates([*key, "epoch"]) if keep_last else best
    return kept.withColumn("name", checkpoint_name(F.col("epoch"), F.col("val_wer")))


def _lowest(log: DataFrame, run: str, keep: int, *order) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(run).orderBy(*order))
    return log.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")
