"""Records of delimited files whose quoted cells hold line breaks, parsed by many tasks per file.

Spark splits a file at line breaks without knowing which lie in quotes. Read from either of the two
states a line can begin in, outside or inside a quoted cell, every split leads to one of the two. That
is one row per split; composing them in file order tells where each split really begins. Then every
task cuts its own lines into records, and the few that cross a split are put together from their pieces.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_BYTES = 8 << 20


def still_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether the end of a line lies in a quoted cell. Quotes count only where a cell begins with one."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line[at:at + 1] == '"':
                inside, at = True, at + 1
            else:
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
        at = line.find('"', at)
        if at < 0:
            return True
        if line[at + 1:at + 2] == '"':
            at += 2
            continue
        inside = False
        at = line.find(sep, at + 1) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, line`` in file order within each split; a carriage return stays at its line's end."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str], bool]]:
    """Lines of one split after the other, in portions; True with the last portion of a split."""
    key, held = None, []
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        for file, start, line in zip(files, starts, batch.column("line").to_pylist()):
            if (file, start) != key:
                if key:
                    yield key, held, True
                key, held = (file, start), []
            held.append(line)
        if key and held:
            yield key, held, False
            held = []
    if key:
        yield key, held, True


def split_ends(spark: SparkSession, path: str, sep: str) -> dict[str, list[tuple[int, bool, bool, bool]]]:
    """For each file its splits in order: start, state at the end if it begins outside and if inside
    quotes, and whether a record begins in it in the latter case. One row per split comes to the driver."""

    def run(batches):
        ends, begun = [False, True], False
        for (file, start), lines, last in _splits(batches):
            for line in lines:
                begun = begun or not ends[1]
                ends = [still_inside(line, inside, sep) for inside in ends] if ends[0] != ends[1] else [
                    still_inside(line, ends[0], sep)] * 2
            if last:
                yield pa.RecordBatch.from_pylist(
                    [{"file": file, "start": start, "outside": ends[0], "inside": ends[1], "begun": begun}])
                ends, begun = [False, True], False

    told = _lines(spark, path).mapInArrow(run, "file string, start bigint, outside boolean, inside boolean, begun boolean")
    found: dict[str, list] = {}
    for r in sorted(told.collect()):
        found.setdefault(r["file"], []).append((r["start"], r["outside"], r["inside"], r["begun"]))
    return found


def entered_inside(ends: dict[str, list[tuple[int, bool, bool, bool]]]) -> dict[tuple[str, int], int]:
    """The splits that begin inside a quoted cell, each with the split in which that cell's record begins."""
    out = {}
    for file, splits in ends.items():
        inside, owner = False, 0
        for start, if_outside, if_inside, begun in splits:
            if inside:
                out[file, start] = owner
            if not inside or begun:
                owner = start
            inside = if_inside if inside else if_outside
    return out


def quoted_records(spark: SparkSession, path: str, sep: str, header: list[str] | None) -> DataFrame:
    """``record``: the rows of all files below ``path`` as text, line breaks in quotes included.

    The first record of each file is left out; if ``header`` is given, its cells must equal it. Empty
    lines are no records. Carriage returns before line breaks are left out if the file's header has one.
    """
    ends = split_ends(spark, path, sep)
    owners = entered_inside(ends)  # at most one entry per split
    last_inside = {file for file, splits in ends.items() if splits and (
        splits[-1][2] if (file, splits[-1][0]) in owners else splits[-1][1])}

    def pieces(batches, whole: bool):
        """Whole records, or else pieces of those that cross a split."""
        out, size = [], 0
        inside, open_lines, head, crossing, old = False, [], True, False, None
        for (file, start), lines, last in _splits(batches):
            if (file, start) != old:
                old, inside = (file, start), (file, start) in owners
                open_lines, head, crossing = [], start == 0, inside
            for line in lines:
                open_lines.append(line)
                inside = still_inside(line, inside, sep)
                if inside:
                    continue
                record, open_lines = "\n".join(open_lines), []
                if crossing:
                    crossing = False
                    if not whole:
                        out.append((record, file, owners[file, start], start))
                elif head:
                    head = False
                    if whole and header is not None:
                        cells = next(csv.reader(io.StringIO(record.rstrip("\r")), delimiter=sep), [])
                        if cells != header:
                            raise ValueError(f"header {cells} of {file} is not {header}")
                elif whole:
                    out.append((record, file, None, start))
                    size += len(record)
            if last and open_lines:
                rest = "\n".join(open_lines)
                if crossing:
                    if not whole:
                        out.append((rest, file, owners[file, start], start))
                elif head:
                    raise ValueError(f"the header of {file} does not end in its first split")
                elif file in last_inside and start == ends[file][-1][0]:
                    if whole:  # the file ends inside quotes
                        out.append((rest, file, None, start))
                elif not whole:
                    out.append((rest, file, start, start))
            if out and (last or size > HELD_BYTES):
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                    ["record", "file", "owner", "start"])
                out, size = [], 0

    schema = "record string, file string, owner bigint, start bigint"
    records = _lines(spark, path).mapInArrow(lambda b: pieces(b, True), schema).select("record")
    if owners:
        parts = _lines(spark, path).mapInArrow(lambda b: pieces(b, False), schema)
        in_order = F.sort_array(F.collect_list(F.struct("start", "record")))
        crossing = parts.groupBy("file", "owner").agg(
            F.array_join(F.transform(in_order, lambda p: p["record"]), "\n").alias("record"))
        records = records.unionByName(crossing.select("record"))
    return records.select(F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "").alias("record")).where("record != ''")
