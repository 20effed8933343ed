"""Transcripts to a byte-pair vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame

from speechloom.operators.folding import folded_frequencies
from speechloom.operators.vocabulary import (
    char_coverage,
    corpus_text,
    merges_table,
    train_bpe,
    vocabulary,
    word_frequencies,
)
from speechloom.schema import CONTROL_PIECES
from speechloom.workspace import written


def train_tokenizer(
    train_split: DataFrame, text: str = "text", vocab_size: int = 1024, coverage: float = 0.9999, fold: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Merges and vocabulary from the transcripts of the train split, before any audio filter.

    ``fold`` applies Unicode compatibility folding to the words first, as public trainers do by default.
    """
    spark = train_split.sparkSession
    frequencies = written((folded_frequencies if fold else word_frequencies)(corpus_text(train_split, text)), "words")
    if frequencies.isEmpty():
        raise ValueError("no text found in training data")
    chars = written(char_coverage(frequencies, coverage), "chars")
    room = vocab_size - len(CONTROL_PIECES) - chars.count()
    if room < 0:
        raise ValueError(f"vocab_size {vocab_size} is too small for {-room} of the characters")
    learned = train_bpe(frequencies, room, coverage)
    return merges_table(spark, learned), vocabulary(spark, learned, chars)
