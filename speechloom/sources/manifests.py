"""Manifests, reports and other files the jobs read and write."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.schema import MANIFEST
from speechloom.workspace import make_dir, path_exists


def _given(name: str):
    """True, or the end of the query. As a filter it is looked at whatever columns are asked for."""
    message = F.lit(f"manifest row without {name}")
    return F.when(F.col(name).isNotNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines manifest. Malformed rows and rows without path or text fail the query."""
    df = spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(path)
    return df.where(_given("audio_filepath") & _given("text")).select("audio_filepath", "text", "duration")


def write_manifest(
    df: DataFrame, path: str, splits: tuple[str, ...] = ("train", "val"), mode: str = "errorifexists"
) -> None:
    """JSON lines, one folder per split; a split without rows still gets its (empty) folder."""
    (
        df.select("split", "audio_filepath", "text", "duration")
        .write.mode(mode)
        .partitionBy("split")
        .option("ignoreNullFields", False)
        .json(path)
    )
    for split in splits:
        make_dir(df.sparkSession, split_path(path, split))


def split_path(path: str, split: str) -> str:
    return f"{path.rstrip('/')}/split={split}"


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return read_manifest(spark, split_path(path, split)).withColumn("split", F.lit(split))


def union_splits(parts: dict[str, DataFrame]) -> DataFrame:
    """Manifests of several splits as one table with a ``split`` column."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    return union


def read_local_manifests(
    spark: SparkSession, train_path: str | None, val_path: str | None = None
) -> dict[str, DataFrame]:
    """Train must exist; a missing val manifest is a warning and an empty table."""
    if not train_path:
        raise ValueError("training manifest not specified")
    if not path_exists(spark, train_path):
        raise FileNotFoundError(f"training manifest not found: {train_path}")
    if val_path and path_exists(spark, val_path):
        val = read_manifest(spark, val_path)
    else:
        if val_path:
            warnings.warn(f"validation manifest not found: {val_path}", stacklevel=2)
        val = spark.createDataFrame([], MANIFEST)
    return {"train": read_manifest(spark, train_path), "val": val}


def reuse_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool = False
) -> dict[str, DataFrame]:
    """Finished train and val manifests at ``path``; built there first unless ``reuse`` is set."""
    if reuse:
        needed = [f"{path}/_SUCCESS", split_path(path, "train"), split_path(path, "val")]
        missing = [p for p in needed if not path_exists(spark, p)]
        if missing:
            raise FileNotFoundError(f"nothing to reuse, missing: {missing}")
    else:
        write_manifest(build(), path)
    return {split: read_manifest(spark, split_path(path, split)) for split in ("train", "val")}


def write_corpus_text(df: DataFrame, path: str) -> None:
    """One transcript per line; line breaks inside a transcript start new lines."""
    df.select("text").write.text(path)


def write_report(metrics: DataFrame, samples: DataFrame, path: str) -> bool:
    """``metrics`` as one indented JSON document, ``samples`` as JSON lines beside it.

    Nothing is written when there are no samples.
    """
    if samples.isEmpty():
        return False
    document = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    metrics.select(document.alias("value")).coalesce(1).write.text(f"{path}/metrics")
    samples.write.option("ignoreNullFields", False).json(f"{path}/samples")
    return True
