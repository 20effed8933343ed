import unicodedata
from collections import Counter

import pytest

from speechloom.operators.folding import DROPPED, fold, folded_frequencies
from speechloom.operators.vocabulary import WORD_START, corpus_text
from speechloom.plans.tokenizer import train_tokenizer

FORMS = ["ﬁne", "ＦＵＬＬ　ｗｉｄｔｈ", "①②", "㌔", "ｶﾞ", "x²", "ﬀ～ﬀ", "a\u200bb", "\ufeffzero", "cafe\u0301", "Å", "\u2581mark", "हिन्दी", "½"]


def test_folding_like_the_public_normalizer():
    sentencepiece = pytest.importorskip("sentencepiece")
    public = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")

    def want(text):
        return public.normalize(text).replace("▁", " ").strip()

    clean = str.maketrans("", "", DROPPED)
    for text in FORMS:
        assert fold(text.translate(clean)) == want(text), text
    # one by one, but for two that the public table treats otherwise and those that it does not know yet
    for c in range(1, 0x20000):
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn" and c not in (0x85, 0x344):
            assert fold(f"a{chr(c)}b".translate(clean)) == want(f"a{chr(c)}b"), hex(c)


def test_words_that_fold_to_the_same_add_up(spark):
    texts = ["ﬁne ＦＩＮＥ fine", "fine\u200bfine x\x01y", "\u200b", None, "", " ", "ＦＩＮＥ"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.word: r.n for r in folded_frequencies(corpus_text(df)).collect()}
    assert got == {WORD_START + w: n for w, n in Counter({"fine": 4, "FINE": 2, "xy": 1}).items()}
    assert folded_frequencies(df.limit(0)).collect() == []


def test_training_on_folded_words(spark):
    plain = ["fine first office 2024 ab"] * 3 + ["file flag"]
    shown = [t.replace("fi", "ﬁ").replace("ab", "ａｂ") for t in plain]
    tables = []
    for texts, fold_them in ((plain, False), (shown, True)):
        merges, pieces = train_tokenizer(spark.createDataFrame([(t,) for t in texts], "text string"), vocab_size=40, fold=fold_them)
        tables.append((sorted(map(tuple, merges.collect())), sorted(map(tuple, pieces.collect()))))
    assert tables[0] == tables[1]
