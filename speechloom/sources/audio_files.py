"""Directories of audio files."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechloom.functions.paths import absolute_dir, plain_path
from speechloom.functions.waveform import audio_duration, wav_duration
from speechloom.schema import AUDIO_EXTENSIONS
from speechloom.workspace import fresh_dir, path_exists

# files that one task has open at a time
OPEN_FILES = 8
# folders that one task of a listing goes through
FOLDERS = 256
LISTED_ROWS = 10_000
LISTED = "path string, length bigint"


def union_extensions(extensions: tuple[str, ...] | list[str] = AUDIO_EXTENSIONS) -> str:
    """One glob for each extension as given and in upper case, without repeats."""
    forms = [form for e in extensions for form in (e, e.upper())]
    return "*{" + ",".join(dict.fromkeys(forms)) + "}"


def scan_audio_dir(
    spark: SparkSession,
    path: str,
    extensions: tuple[str, ...] | list[str] = AUDIO_EXTENSIONS,
    content: bool = False,
) -> DataFrame:
    """``path, length`` of the audio files below ``path``, in the form that resolved transcript paths have.

    Folders are listed by tasks (``listed_files``) when this is called. File bytes come only on request:
    then Spark's reader lists them and holds each file in one value, so one of 2 GB or more ends a job
    that asks for them. Durations and resampling don't need them. Spark's reader also lists for paths
    with glob characters.
    """
    if not content and not re.search(r"[*?{\[]", path):
        return listed_files(spark, path, extensions)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", union_extensions(extensions))
        .load(path)
    )
    plain = plain_path(F.col("path"), default_fs(spark)).alias("path")
    columns = [plain, "length"] + (["content"] if content else [])
    return files.select(*columns)


def _listing(default: str, endings: tuple[str, ...]) -> Callable:
    """Lists the folders that it is handed and those found in them, up to ``FOLDERS``; hands on the rest."""

    def run(batches):
        from pyarrow import fs

        opened = file_opener(default)
        for batch in batches:
            rest = deque(batch.column("path").to_pylist())
            for _ in range(max(FOLDERS, len(rest))):
                if not rest:
                    break
                folder = rest.popleft()
                client, name = opened(folder)
                # a folder that is gone by now has no files
                found = client.get_file_info(fs.FileSelector(name or "/", allow_not_found=True))
                files = []
                for info in found:
                    # hidden names, as Spark's readers have it
                    if info.base_name.startswith((".", "_")):
                        continue
                    below = f"{folder.rstrip('/')}/{info.base_name}"
                    if info.type == fs.FileType.Directory:
                        rest.append(below)
                    elif info.type == fs.FileType.File and info.base_name.endswith(endings):
                        files.append((below, info.size))
                for at in range(0, len(files), LISTED_ROWS):
                    yield _listed_batch(files[at:at + LISTED_ROWS], False)
            yield _listed_batch([(path, 0) for path in rest], True)

    return run


def _listed_batch(rows: list[tuple[str, int]], is_folder: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([is_folder] * len(rows), pa.bool_())], ["path", "length", "is_folder"])


def listed_files(
    spark: SparkSession, path: str, extensions: tuple[str, ...] | list[str] = AUDIO_EXTENSIONS
) -> DataFrame:
    """``path, length`` of the files with these extensions below a folder, listed by tasks, breadth first.

    A round takes the folders that are known but not listed yet, deals them out and writes what it finds;
    the folders among that are the next round's. A task goes on into what it finds for up to ``FOLDERS``
    folders, so a small tree takes one round and a large one few more than it needs for its width. The
    driver sees no file and no folder but the first, only whether folders are left. Needs a file system
    that the executors' Arrow library can open.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    default = default_fs(spark)
    endings = tuple(form for e in extensions for form in dict.fromkeys((e, e.upper())))
    root = absolute_dir(path, default_fs=default)
    frontier = spark.createDataFrame([(root,)], "path string")
    levels, n = [], 1
    while n:
        tasks = min(-(-n // FOLDERS), 100 * spark.sparkContext.defaultParallelism)
        dealt = frontier.coalesce(1) if tasks == 1 else frontier.repartition(tasks, "path")
        out = fresh_dir(spark, "listed")
        # folders and files apart, so that each is read alone
        dealt.mapInArrow(_listing(default, endings), f"{LISTED}, is_folder boolean").write.partitionBy("is_folder").parquet(out)
        level = spark.read.schema(f"{LISTED}, is_folder boolean").parquet(out)
        levels.append(level)
        frontier = level.where("is_folder").select("path")
        n = frontier.count()
    return reduce(DataFrame.unionByName, levels).where("NOT is_folder").select("path", "length")


def default_fs(spark: SparkSession) -> str:
    """The file system of paths without a scheme."""
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"


def file_opener(default: str = "file:///") -> Callable:
    """For use inside a task: gives the Arrow file system and name of a path or URI, one client per system."""
    from pyarrow import fs

    clients: dict[str, tuple] = {}

    def opened(path: str):
        if "://" not in path and not path.startswith("file:") and not default.startswith("file:"):
            path = default.rstrip("/") + path
        uri = re.match(r"([A-Za-z][A-Za-z0-9+.-]*://[^/]*)(/.*)", path, re.S)
        root = uri.group(1) if uri and not path.startswith("file:") else ""
        if root not in clients:
            clients[root] = fs.FileSystem.from_uri(root + "/") if root else (fs.LocalFileSystem(), "")
        client, base = clients[root]
        # only the root is a URI: names may hold blanks and percent signs
        return client, base.rstrip("/") + uri.group(2) if root else re.sub("^file:(//)?(?=/)", "", path)

    return opened


def sort_by_path(df: DataFrame) -> DataFrame:
    return df.orderBy("path")


@F.arrow_udf(T.DoubleType())
def _probed(head: pa.Array, size: pa.Array) -> pa.Array:
    durations = [wav_duration(c.as_buffer(), n) for c, n in zip(head, size.to_pylist())]
    return pa.array(durations, pa.float64())


def probe_wav_duration(content: Column) -> Column:
    """Seconds of each WAV file, NULL when it cannot be read.

    Of files with the usual 44-byte header only these bytes are handed to Python.
    """
    usual = (
        (F.substring(content, 13, 8) == F.lit(bytearray(b"fmt \x10\x00\x00\x00")))
        & (F.substring(content, 37, 4) == F.lit(bytearray(b"data")))
    )
    head = F.when(usual, F.substring(content, 1, 44)).otherwise(content)
    return _probed(head, F.octet_length(content))


def probed_files(files: DataFrame) -> DataFrame:
    """``path, measured`` from a listing: seconds of WAV, FLAC and Ogg files of any size, else NULL.

    Each task opens its files itself, several at a time, and reads only their headers (of Ogg files
    the last page, too). Needs a file system that the executors' Arrow library can open (local or
    mounted folders, and hdfs, s3, gs with credentials in the environment). A file that vanished or
    cannot be opened fails the job: it says nothing about the audio. Of a table that already has
    ``content``, such as WAVs in Parquet, that is looked at instead.
    """
    if "content" in files.columns:
        return files.select("path", probe_wav_duration(F.col("content")).alias("measured"))
    default = default_fs(files.sparkSession)

    def read(batches):
        opened = file_opener(default)

        def seconds(path: str, length: int) -> float | None:
            client, name = opened(path)
            with client.open_input_file(name) as stream:
                return audio_duration(stream, int(length))

        with ThreadPoolExecutor(OPEN_FILES) as pool:
            for batch in batches:
                measured = list(pool.map(seconds, batch["path"], batch["length"]))
                yield pd.DataFrame({"path": batch["path"], "measured": pd.Series(measured, dtype="float64")})

    return files.select("path", "length").mapInPandas(read, "path string, measured double")


def probed_headers(files: DataFrame) -> DataFrame:
    """``path, measured`` from a listing, never from contents."""
    return probed_files(files.select("path", "length"))
