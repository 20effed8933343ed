"""Unicode compatibility folding of corpus words, as public subword trainers apply it by default."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.functions.text import words
from speechloom.operators.vocabulary import WORD_START

# Characters that the folding drops, and those that it takes for a space besides white space.
DROPPED = "".join(map(chr, [*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, 0x8F, 0x9F]))
SPACES = "\u061c\u200b\u200c\u200e\u200f\u2581\ufeff\ufffd"
KEPT = "\uff5e"  # the full-width tilde is no tilde


def fold(text: str) -> str:
    """NFKC with zero-width and byte-order characters as spaces; parts between single spaces."""
    spaced = re.sub(f"[{SPACES}]", " ", text)
    parts = (unicodedata.normalize("NFKC", part) for part in spaced.split(KEPT))
    return " ".join(KEPT.join(parts).split())


def folded_frequencies(corpus: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` like ``word_frequencies``, of folded words.

    Control characters go from the texts, inside the JVM, before these are split into words. Only
    different words are folded: they are counted first, and counts of words that fold to the same are
    added up. A word that folds to several, as around a zero-width space, counts as each of them; one
    that folds to nothing goes. Null texts have no words.
    """
    cleaned = F.translate(F.col(text), DROPPED, "")
    counted = corpus.select(F.explode(words(cleaned)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))

    def run(batches):
        for batch in batches:
            found = [(part, n) for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist())
                     for part in fold(word).split(" ") if part]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["word", "n"])

    return counted.mapInArrow(run, "word string, n bigint").groupBy(
        F.concat(F.lit(WORD_START), F.col("word")).alias("word")).agg(F.sum("n").alias("n"))
