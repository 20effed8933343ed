"""Transcript expressions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from speechloom.schema import WHITESPACE

# Java's Unicode \s lacks the four separators U+001C to U+001F that Python counts as white space.
_SPACE = r"\s\x1c-\x1f"


def strip_text(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_spaces(text: Column) -> Column:
    return strip_text(F.regexp_replace(text, f"(?U)[{_SPACE}]+", " "))


def normalize_text(text: Column, keep_marks: bool = False) -> Column:
    """Lower case, letters/digits/underscore/space only, single spaces.

    Combining marks are removed like other punctuation unless ``keep_marks`` is set; Devanagari
    and similar scripts need it to keep their vowel signs.
    """
    marks = r"\p{M}" if keep_marks else ""
    kept = F.regexp_replace(F.lower(text), rf"(?U)[^\p{{L}}\p{{N}}_{_SPACE}{marks}]", "")
    return collapse_spaces(kept)


def normalizes_to_nothing(text: Column, keep_marks: bool = False) -> Column:
    """Whether ``normalize_text`` leaves an empty text; stops at the first character it keeps."""
    marks = r"\p{M}" if keep_marks else ""
    return ~text.rlike(rf"[\p{{L}}\p{{N}}_{marks}]")


def append_language_tag(text: Column, tag: str | Column | None) -> Column:
    """``text <tag>``; an empty or missing tag leaves the text alone."""
    if tag is None or (isinstance(tag, str) and tag == ""):
        return text
    tag = F.lit(tag) if isinstance(tag, str) else tag
    tagged = F.concat(text, F.lit(" <"), tag, F.lit(">"))
    return F.when(F.coalesce(tag, F.lit("")) == "", text).otherwise(tagged)


def strip_language_tag(text: Column, tag: str | None = None) -> Column:
    """Without the tag at the end: the one named, or else any language tag like ``hi``, ``en-US``, ``es-419``, ``sr-Cyrl-RS``."""
    if tag is not None:
        end = F.lit(f"<{tag}>")
        return F.when(text.endswith(end), F.rtrim(F.substr(text, F.lit(1), F.length(text) - F.length(end)))).otherwise(text)
    return F.regexp_replace(text, r"\s*<[A-Za-z]{2,3}(-[A-Za-z0-9]{1,8})*>$", "")


def words(text: Column) -> Column:
    """Words between Unicode white space; an empty array for blank text."""
    stripped = strip_text(text)
    return (
        F.when(stripped == "", F.array().cast("array<string>"))
        .when(stripped.isNotNull(), F.split(stripped, f"(?U)[{_SPACE}]+"))
    )


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def null_tokens_to_empty(cell: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(cell.isNull() | cell.isin(*tokens), F.lit("")).otherwise(cell)
