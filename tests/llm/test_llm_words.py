"""Words that a sum over places would take for equal, and very long runs of white space."""

import time

import cases
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
import public_tokenizers

from speechloom.llm import common, minhash, packing, substrings


def thue_morse(n):
    word = "ab"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word[:n], word[:n].translate(str.maketrans("ab", "ba"))


def hashes(words, **options):
    data, offsets = common.utf8(pa.array([" ".join(words)]))
    first, end, _ = common.word_spans(data, offsets)
    return common.WordHasher(6, **options)(data, first, end)


def test_different_words_differ():
    rng = np.random.default_rng(1)
    words = {*thue_morse(1024), *thue_morse(512), *thue_morse(256), "a" * 511, "a" * 512, "a" * 513, "a" * 514, "b" + "a" * 513}
    words |= {"".join(rng.choice(list("abé漢"), rng.integers(1, 40))) for _ in range(5000)}
    words |= {"x" * n for n in range(1, 40)}
    words = sorted(words)
    h = hashes(words)
    assert len(set(h.tolist())) == len(words)
    assert (hashes(words[::-1])[::-1] == h).all()  # wherever they stand
    assert (hashes([w.upper() if w.isascii() else w for w in words], lower=True) == hashes(words, lower=True)).all()
    assert hashes(["AB"])[0] != hashes(["ab"])[0]
    bits = np.unpackbits(h.view(np.uint8)).reshape(len(h), 64).mean(axis=0)
    assert np.abs(bits - 0.5).max() < 0.05


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_colliding_words_are_not_repeats(spark, n):
    one, other = thue_morse(n)
    rows = [(1, " ".join([one] * 25), "en", "a", 1), (2, " ".join([other] * 25), "en", "a", 1)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert (got[1].n_removed, got[2].n_removed) == (24, 24)  # each within its own text: all words but the first
    kept = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, width=3, percent=85).collect()}
    assert kept == {1: 1, 2: 2}


@pytest.mark.parametrize("text", ["x" + " " * 2_000_000 + "y", "x" + "\n" * 2_000_000 + "y", "a \t\n" * 300_000, " " * 9_999 + "b"])
def test_long_runs_of_white_space(text):
    whole = Tokenizer.from_file(public_tokenizers.path(f"{packing.VOCABULARY}.json"))
    begin = time.time()
    assert packing.Encoder(packing.VOCABULARY)(text) == whole.encode(text, add_special_tokens=False).ids
    assert time.time() - begin < 60


def test_pack_takes_long_white_space(spark):
    rows = [(1, "x" + " " * 1_200_000 + "y", "en", "a", 1), (2, "a b c", "en", "a", 1)]
    pieces = packing.pack(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert {r.doc_id for r in pieces} == {1, 2}
