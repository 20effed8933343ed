"""Rows that operators must take: nulls, empty and very long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# names that operators use inside
CLASHES = ("copy", "order_key", "seeds", "bucket", "component", "k1", "rank", "length", "spans", "x", "n")


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(spark, more=()):
    """The fixed awkward rows and ``more``, with extra columns of clashing names."""
    rng = random.Random(7)
    long = prose(rng, 30_000)
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 70),
        (2, None, "en", "a", None),
        (3, "", None, "a", 0),
        (4, " \t\n ", "de", None, 4),
        (None, "a text without an id, but with some words in it", "en", "b", 40),
        (5, long, "en", "b", len(long)),
        (6, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 70),
        (7, "Straße ñandú naïve 漢字 😀 mail bob@example.com +1 (555) 010-9999", "de", "b", 60),
        (7, "Straße ñandú naïve 漢字 😀 mail bob@example.com +1 (555) 010-9999", "de", "b", 60),
        (8, "x", "fr", "c", 1),
        (9, "12345 !!! ...", "en", "c", 13),
        *more,
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
