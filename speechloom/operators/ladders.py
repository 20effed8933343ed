"""Why a row is skipped: ordered checks, the first that holds gives the reason, NULL means valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechloom.functions.text import append_language_tag, normalize_text, strip_text
from speechloom.operators.embedded import embedded_duration, is_embedded
from speechloom.schema import COMPACT_REASON, TARGET_RATE

# Number grammar of a supplied duration: digits may be grouped by single underscores.
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_INFINITY = r"(?i)^[+-]?inf(?:inity)?$"


def within_duration(duration: Column, shortest: float, longest: float) -> Column:
    return duration.between(shortest, longest)


def _range_checks(duration: Column, shortest: float, longest: float) -> list[tuple[Column, str]]:
    return [(duration < shortest, "too_short"), (duration > longest, "too_long")]


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    reason = F.when(*checks[0])
    for check in checks[1:]:
        reason = reason.when(*check)
    return reason


def parse_duration(supplied: Column) -> Column:
    """Supplied duration as a number; NULL for anything that is not one."""
    cell = strip_text(supplied)
    number = F.when(cell.rlike(_NUMBER), F.replace(cell, F.lit("_"), F.lit("")))
    return F.coalesce(number, F.when(cell.rlike(_INFINITY), cell)).try_cast("double")


def override_duration(supplied: Column, measured: Column) -> Column:
    return F.coalesce(parse_duration(supplied), measured)


def round_duration(duration: Column) -> Column:
    return F.round(duration, 3)


def drop_empty_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(strip_text(F.col(text)) != "")


def guard_text(df: DataFrame, text: str) -> Column:
    """The text column, NULL where it is missing, empty or not a string."""
    field = {f.name: f.dataType for f in df.schema}.get(text)
    if not isinstance(field, T.StringType):
        return F.lit(None).cast("string")
    return F.when(F.col(text) != "", F.col(text))


def skip_reason_local(
    found: Column,
    measured: Column,
    duration: Column,
    shortest: float,
    longest: float,
    text: Column | None = None,
    audio: Column | None = None,
    nothing_left: Column | None = None,
) -> Column:
    """Transcript rows checked against audio files.

    ``duration`` is the supplied or else the measured one; both it and the measured one must be in
    range. ``text`` and ``audio`` (the path as given) may be left out where they are known not to
    be blank. An empty path names the folder itself, which exists but cannot be read.
    ``nothing_left`` tells whether normalising empties the text; it is looked at last.
    """
    checks = [] if text is None else [(strip_text(text) == "", "empty_text")]
    if audio is not None:
        checks.append((audio == "", "read_error"))
    checks += [
        (~found, "not_found"),
        (measured.isNull(), "read_error"),
        (measured < shortest, "too_short"),
        (measured > longest, "too_long"),
        *_range_checks(duration, shortest, longest),
    ]
    if nothing_left is not None:
        checks.append((nothing_left, "empty_text"))
    return _first_reason(checks)


def skip_reason_local_resampled(
    measured: Column,
    duration: Column,
    shortest: float,
    longest: float,
    text: Column | None = None,
    nothing_left: Column | None = None,
) -> Column:
    """As above after resampling: any file failure is a read error, and a supplied duration
    replaces the measured one before the only range check."""
    checks = [] if text is None else [(strip_text(text) == "", "empty_text")]
    checks += [(measured.isNull(), "read_error"), *_range_checks(duration, shortest, longest)]
    if nothing_left is not None:
        checks.append((nothing_left, "empty_text"))
    return _first_reason(checks)


def duration_of_waveform(df: DataFrame, audio: str = "audio") -> Column:
    """Samples over rate; NULL for a NULL or zero rate. The rate is 16000 if there is no such field.

    Of an embedded file, which comes as bytes, the seconds that its headers tell.
    """
    if is_embedded(df.schema[audio].dataType):
        return embedded_duration(F.col(audio)["bytes"])
    rate = (
        F.col(audio)["sampling_rate"]
        if "sampling_rate" in df.schema[audio].dataType.names
        else F.lit(TARGET_RATE)
    )
    return F.try_divide(F.size(F.col(audio)["array"]).cast("double"), rate.cast("double"))


def skip_reason_dataset(
    df: DataFrame, shortest: float, longest: float, audio: str = "audio", text: str = "text"
) -> Column:
    """Dataset rows with an embedded waveform or audio file, eight reasons.

    A file without bytes has no samples; one that cannot be read is an error.
    """
    if audio not in df.columns:
        return F.lit("no_audio_col")
    missing = F.when(F.col(audio).isNull(), "no_audio_col")
    kind = df.schema[audio].dataType
    if not isinstance(kind, T.StructType):
        return missing.otherwise("audio_not_dict")
    samples = "bytes" if is_embedded(kind) else "array"
    if samples not in kind.names:
        return missing.otherwise("no_array")
    given = guard_text(df, text)
    duration = duration_of_waveform(df, audio)
    return _first_reason([
        (F.col(audio).isNull(), "no_audio_col"),
        (F.col(audio)[samples].isNull(), "no_array"),
        (given.isNull(), "no_text"),
        (strip_text(given) == "", "empty_text"),
        (duration.isNull(), "error"),
        *_range_checks(duration, shortest, longest),
    ])


def skip_reason_dataset_compact(reason: Column) -> Column:
    """The eight dataset reasons folded into five."""
    folded = F.create_map(*[F.lit(x) for pair in COMPACT_REASON.items() for x in pair])
    return F.try_element_at(folded, reason)


def manifest_text(text: Column, normalize: bool = False, keep_marks: bool = False,
                  language_tag: str | None = None) -> Column:
    """Transcript as written to the manifest: stripped, optionally normalised, then tagged."""
    text = normalize_text(text, keep_marks) if normalize else strip_text(text)
    return append_language_tag(text, language_tag)


def to_manifest(df: DataFrame, *keep: str) -> DataFrame:
    """Valid rows in manifest shape; ``keep`` names further columns to carry along."""
    return df.where(F.col("reason").isNull()).select(
        *keep, "audio_filepath", "text", round_duration(F.col("duration")).alias("duration")
    )


def skip_summary(df: DataFrame, *by: str) -> DataFrame:
    """Rows per skip reason."""
    return (
        df.where(F.col("reason").isNotNull())
        .groupBy(*by, "reason")
        .agg(F.count("*").alias("n"))
    )
