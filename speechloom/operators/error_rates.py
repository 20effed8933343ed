"""Word alignment and corpus error rates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechloom.functions.edit_cost import edit_counts
from speechloom.functions.text import count_words, strip_language_tag, strip_text
from speechloom.schema import ALIGNMENT


@F.pandas_udf(ALIGNMENT)
def _aligned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for references, hypotheses in batches:
        yield edit_counts([r.split() for r in references], [h.split() for h in hypotheses])


def word_alignment(reference: Column, hypothesis: Column) -> Column:
    """Substitutions, deletions, insertions and hits of the cheapest word alignment.

    Among alignments with the fewest edits, one with the fewest substitutions is counted. A missing
    text counts as empty.
    """
    return _aligned(F.coalesce(reference, F.lit("")), F.coalesce(hypothesis, F.lit("")))


def count_reference_words(pairs: DataFrame, reference: str = "reference") -> DataFrame:
    return pairs.agg(F.coalesce(F.sum(count_words(F.col(reference))), F.lit(0)).alias("num_reference_words"))


def corpus_error_rates(pairs: DataFrame, strip_tag: bool | str = False) -> DataFrame:
    """One row: pooled wer, mer, wil, wip and counts over pairs with a non-blank reference.

    ``strip_tag`` takes the language tag off first, any or the one named; a text that is only a tag
    is blank.
    """
    pairs = pairs.select("reference", "hypothesis")
    if strip_tag:
        tag = strip_tag if isinstance(strip_tag, str) else None
        pairs = pairs.select(*[strip_language_tag(F.col(c), tag).alias(c) for c in pairs.columns])
    pairs = pairs.where(strip_text(F.col("reference")) != "")
    counts = pairs.select(word_alignment(F.col("reference"), F.col("hypothesis")).alias("a")).select("a.*")
    return pooled_rates(counts)


def pooled_rates(counts: DataFrame) -> DataFrame:
    """Error rates from per-pair alignment counts."""
    totals = counts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ALIGNMENT.names],
        F.count("*").alias("num_samples"),
    )
    s, d, i, h = (F.col(c) for c in ALIGNMENT.names)
    n, p = h + s + d, h + s + i
    wip = F.when(F.col("num_samples") == 0, None).otherwise(
        F.when(p == 0, 0.0).otherwise(F.try_divide(h, n) * F.try_divide(h, p))
    )
    return totals.select(
        F.try_divide(s + d + i, n).alias("wer"),
        F.try_divide(s + d + i, n + i).alias("mer"),
        (1 - wip).alias("wil"),
        wip.alias("wip"),
        s.alias("substitutions"),
        d.alias("deletions"),
        i.alias("insertions"),
        n.alias("num_reference_words"),
        "num_samples",
        F.when(F.col("num_samples") == 0, "No valid reference texts").alias("error"),
    )
