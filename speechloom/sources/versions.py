"""Manifests in versions: readers see a whole version or the one before it, never half a build.

Each build goes to a folder of its own below ``versions``. Once all splits are written, a small file
below ``pointers``, numbered upwards and created only if its name is free, names that folder. Readers
take the highest finished pointer. Nothing that a reader may have open is ever overwritten, so a build
that dies leaves no more than a folder that no pointer names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from speechloom.sources.manifests import read_manifest, split_path, write_manifest
from speechloom.workspace import _hadoop_path, path_exists

SPLITS = ("train", "val")
END = "\n"  # a pointer without it is still being written


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []


def _pointers(spark: SparkSession, path: str) -> dict[int, str]:
    """Version folder by number, of finished pointers."""
    out = {}
    for name in _names(spark, f"{path}/pointers"):
        if name.isdigit():
            at, fs = _hadoop_path(spark, f"{path}/pointers/{name}")
            stream = fs.open(at)
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith(END):
                out[int(name)] = text.removesuffix(END)
    return out


def _point(spark: SparkSession, path: str, number: int, version: str) -> bool:
    """Create the pointer, or False if that number is taken."""
    at, fs = _hadoop_path(spark, f"{path}/pointers/{number:010d}")
    try:
        stream = fs.create(at, False)
    except Exception:
        if fs.exists(at):
            return False
        raise
    try:
        stream.write(bytearray((version + END).encode()))
    finally:
        stream.close()
    return True


def publish_manifest(df: DataFrame, path: str, splits: tuple[str, ...] = SPLITS) -> int:
    """Write ``df`` as a new version and make it the current one; its number.

    Of two builds that end at once, both get a number of their own and the later one is current.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    write_manifest(df, f"{path}/versions/{version}", splits)
    # numbers of unfinished pointers stay taken
    number = 1 + max((int(n) for n in _names(spark, f"{path}/pointers") if n.isdigit()), default=0)
    while not _point(spark, path, number, version):
        number += 1
    return number


def version_path(spark: SparkSession, path: str, number: int | None = None) -> str:
    """Folder of a version, by default of the current one."""
    path = path.rstrip("/")
    known = _pointers(spark, path)
    if not known or number is not None and number not in known:
        raise FileNotFoundError(f"no {'finished version' if number is None else f'version {number}'} at {path}")
    return f"{path}/versions/{known[max(known) if number is None else number]}"


def read_version(
    spark: SparkSession, path: str, number: int | None = None, splits: tuple[str, ...] = SPLITS
) -> dict[str, DataFrame]:
    """All splits of one version: the pointer is read once, so they always belong together."""
    folder = version_path(spark, path, number)
    return {split: read_manifest(spark, split_path(folder, split)) for split in splits}


def reuse_or_publish(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool = False
) -> dict[str, DataFrame]:
    """Train and val manifests of the current version; built and published first unless ``reuse`` is set."""
    return read_version(spark, path, None if reuse else publish_manifest(build(), path))


def drop_versions(spark: SparkSession, path: str, keep: int = 2, unfinished: bool = False) -> list[str]:
    """Remove all but the last ``keep`` versions, pointers first; names of the folders removed.

    ``unfinished`` also removes folders that no pointer names; only ask for it while nothing is built.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    path = path.rstrip("/")
    known = _pointers(spark, path)
    old = sorted(known)[:-keep]
    folders = [known.pop(number) for number in old]
    for number in old:
        at, fs = _hadoop_path(spark, f"{path}/pointers/{number:010d}")
        fs.delete(at, False)
    if unfinished:
        folders += [n for n in _names(spark, f"{path}/versions") if n not in known.values() and n not in folders]
    for name in folders:
        if path_exists(spark, f"{path}/versions/{name}"):
            at, fs = _hadoop_path(spark, f"{path}/versions/{name}")
            fs.delete(at, True)
    return folders
