"""Delimited transcript tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.functions.text import null_tokens_to_empty as empty_if_missing
from speechloom.schema import AUDIO_COLUMNS, MISSING_TOKENS, TEXT_COLUMNS
from speechloom.sources.quoted_lines import quoted_records

_ODD_ROW, _MARK = "_odd_row", "\x01"


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Tab, comma or pipe, whichever the first line holds first in that order."""
    first = spark.read.text(path).first()
    line = first[0] if first else ""
    return next((d for d in "\t,|" if d in line), ",")


def resolve_column(columns: list[str], candidates: tuple[str, ...], role: str) -> int:
    """Position of the first candidate found among ``columns``, ignoring case.

    Of several columns equal up to case, the last one is taken.
    """
    positions = {name.lower(): i for i, name in enumerate(columns)}
    for candidate in candidates:
        if candidate.lower() in positions:
            return positions[candidate.lower()]
    raise ValueError(f"no {role} column among {columns}; name it with {role}_column=")


def _named(columns: list[str], name: str) -> int:
    if name not in columns:
        raise ValueError(f"no column {name!r} among {columns}")
    return columns.index(name)


def null_tokens_to_empty(df: DataFrame) -> DataFrame:
    """Missing cells and missing-value tokens become the empty string in every text column."""
    text_columns = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(*[
        empty_if_missing(F.col(f"`{c}`"), MISSING_TOKENS).alias(c) if c in text_columns else F.col(f"`{c}`")
        for c in df.columns
    ])


def read_transcripts(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    audio_column: str | None = None,
    text_column: str | None = None,
    duration_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Columns ``audio``, ``text`` and ``duration`` of a delimited file with a header.

    Missing cells at the end of a row are empty; a row with more cells than the header fails.
    ``multi_line`` is needed only for quoted cells with line breaks. Such files are gone through twice,
    each by many tasks: first to see which splits begin inside quotes.
    """
    sep = sep or sniff_delimiter(spark, path)
    dialect = {"sep": sep, "quote": '"', "escape": '"'}
    reader = spark.read.options(**dialect).option("multiLine", multi_line)
    header = reader.option("header", False).csv(path).first()
    if header is None:
        raise ValueError(f"no header in {path}")
    names = ["" if cell is None else cell for cell in header]
    audio = _named(names, audio_column) if audio_column else resolve_column(names, AUDIO_COLUMNS, "audio")
    text = _named(names, text_column) if text_column else resolve_column(names, TEXT_COLUMNS, "text")
    duration = names.index(duration_column) if duration_column in names else None

    # rows of another length than the header come back whole in one more column; seeing them needs
    # all columns parsed
    reader = reader.options(header=True, columnPruning=False, columnNameOfCorruptRecord=_ODD_ROW)
    if len({n.lower() for n in names}) == len(names) and "" not in names:
        # names are checked against the header of every further file
        reader, checked = reader.option("enforceSchema", False), names
        columns = [f"`{n.replace('`', '``')}`" for n in names]
    else:
        columns, checked = [f"c{i}" for i in range(len(names))], None
    schema = ", ".join(f"{c} STRING" for c in [*columns, _ODD_ROW])
    if multi_line:
        parsed = F.from_csv("record", F.lit(schema), {**dialect, "columnNameOfCorruptRecord": _ODD_ROW})
        df = quoted_records(spark, path, sep, checked).select(parsed.alias("r")).select("r.*")
    else:
        df = reader.schema(schema).csv(path)

    # with marks appended, the last header column of a short row holds a mark
    marked = F.concat(F.rtrim(F.col(_ODD_ROW), F.lit("\r\n")), F.lit(f"{sep}{_MARK}" * len(names)))
    recut = F.from_csv(marked, F.lit(", ".join(f"c{i} STRING" for i in range(len(names)))), dialect)
    is_short = F.coalesce(recut[f"c{len(names) - 1}"] == _MARK, F.lit(False))
    too_long = F.col(_ODD_ROW).isNotNull() & ~is_short

    def cell(i):
        return empty_if_missing(F.col(columns[i]), MISSING_TOKENS)

    complaint = F.raise_error(F.concat(F.lit("more cells than the header: "), F.col(_ODD_ROW)))
    return df.select(
        F.when(too_long, complaint.cast("string")).otherwise(cell(audio)).alias("audio"),
        cell(text).alias("text"),
        (cell(duration) if duration is not None else F.lit("")).alias("duration"),
    )
