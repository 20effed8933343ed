import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from speechloom.operators import vocabulary as V
from speechloom.plans.tokenizer import train_tokenizer
from speechloom.schema import CONTROL_PIECES


def merge_word(symbols, left, right):
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and symbols[i] == left and symbols[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def one_at_a_time(words, merges, alphabet):
    """Plain greedy training: one merge per full recount."""
    table = {w: [c if c in alphabet else None for c in w] for w in words}
    learned = []
    pieces = set()
    while len(pieces) < merges:
        counts = Counter()
        for w, n in words.items():
            for pair in zip(table[w], table[w][1:]):
                if None not in pair:
                    counts[pair] += n
        if not counts:
            break
        (left, right), n = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        learned.append((left, right, n))
        pieces.add(left + right)
        table = {w: merge_word(s, left, right) for w, s in table.items()}
    return learned


def frequencies(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint")


def random_words(seed, letters, n):
    rng = random.Random(seed)
    syllables = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))) for _ in range(8)]
    words = ["▁" + "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    return {w: rng.choice([1, 1, 2, 5, 40]) for w in words}


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abcde"), (3, "abcdefghijklmnop"), (4, "a")])
def test_batched_merges_equal_one_at_a_time(spark, seed, letters):
    words = random_words(seed, letters, 120)
    got = V.train_bpe(frequencies(spark, words), 30, coverage=1.0, table_every=3)
    wanted = one_at_a_time(words, 30, set("".join(words)))
    assert [(l, r, n) for _, l, r, _, n in got] == wanted


def test_short_candidate_list_gives_the_same_merges(spark, monkeypatch):
    words = random_words(5, "abcdef", 150)
    monkeypatch.setattr(V, "CANDIDATES", 4)
    got = V.train_bpe(frequencies(spark, words), 25, coverage=1.0)
    assert [(l, r, n) for _, l, r, _, n in got] == one_at_a_time(words, 25, set("".join(words)))


def test_batches_hold_several_merges():
    top = [(9, "a", "b"), (8, "c", "d"), (7, "b", "x"), (6, "e", "f")]
    assert V.independent_merges(top, True, set(), 9) == top[:2]  # (b, x) is changed by (a, b)
    assert V.independent_merges(top[:2], False, set(), 9) == top[:1]  # ties may lie beyond the list
    assert V.independent_merges(top, True, set(), 1) == top[:1]
    assert V.independent_merges([(5, "a", "a"), (4, "c", "d")], True, set(), 9) == [(5, "a", "a")]
    assert V.independent_merges([(5, "a", "b"), (4, "c", "d"), (4, "x", "a")], True, set(), 9) == [(5, "a", "b")]
    assert V.independent_merges([(5, "a", "b"), (4, "c", "d")], True, {"ab"}, 9) == [(5, "a", "b")]


def test_uncovered_characters_are_not_merged(spark):
    words = {"▁aqb": 10, "▁ab": 8, "▁ac": 500, "▁zz": 1}
    freq = frequencies(spark, words)
    kept = {r["char"] for r in V.char_coverage(freq, 0.99).collect()}
    assert kept == {"▁", "a", "c", "b"}
    got = V.train_bpe(freq, 20, coverage=0.99)
    assert [(l, r, n) for _, l, r, _, n in got] == one_at_a_time(words, 20, kept)


def test_characters_beyond_the_basic_plane_and_controls(spark):
    words = {"▁😀😀a": 9, "▁\x01a\x02b": 7, "▁𝒳b": 4}
    freq = frequencies(spark, words)
    assert {r["char"]: r["n"] for r in V.char_frequencies(freq).collect()}["😀"] == 18
    alphabet = set("".join(words)) - {"\x01", "\x02"}
    got = V.train_bpe(freq, 20, coverage=1.0)
    assert [(l, r, n) for _, l, r, _, n in got] == one_at_a_time(words, 20, alphabet)


def test_word_and_char_frequencies(spark):
    df = spark.createDataFrame([(" a b\na ",), ("",), (None,), ("  ",)], "text string")
    corpus = V.corpus_text(df)
    assert sorted(r[0] for r in corpus.collect()) == ["", "a b\na"]
    assert {r["word"]: r["n"] for r in V.word_frequencies(corpus).collect()} == {"▁a": 2, "▁b": 1}
    assert {r["char"]: r["n"] for r in V.char_frequencies(V.word_frequencies(corpus)).collect()} == {"▁": 3, "a": 2, "b": 1}


def test_train_tokenizer(spark):
    df = spark.createDataFrame([("low lower lowest",), ("new newer newest",)], "text string")
    merges, vocabulary = train_tokenizer(df, vocab_size=24)
    rows = vocabulary.orderBy("id").collect()
    assert [r["piece"] for r in rows[:5]] == ["<pad>", "<unk>", "<s>", "</s>", "<blank>"]
    assert [r["id"] for r in rows] == list(range(24))
    assert len({r["piece"] for r in rows}) == 24
    first = merges.orderBy("rank").first()
    assert (first["piece"], first["n"]) == ("we", 4)
    with pytest.raises(ValueError, match="no text"):
        train_tokenizer(df.where("false"))
    with pytest.raises(ValueError, match="too small"):
        train_tokenizer(df, vocab_size=6)


def test_registered_training_is_whole(spark, monkeypatch):
    """Both outputs at a vocabulary of 1,024, against one merge per full recount."""
    words = {w: n for w, n in random_words(6, "abcdefghijklmnopqrstuvwxyz", 60).items() if n < 40}
    text = [(" ".join([w[1:]] * n),) for w, n in words.items()]
    df = spark.createDataFrame(text, "text string")
    monkeypatch.setattr("checks.queries.S.transcripts", lambda spark, sf_dir: df)
    chars = Counter()
    for w, n in words.items():
        for c in w:
            chars[c] += n
    room = 1024 - len(CONTROL_PIECES) - len(chars)
    wanted = one_at_a_time(words, room, set(chars))
    assert len(wanted) > 64
    merges = entry.queries()["tokenizer_merges"](spark, "").orderBy("rank").collect()
    assert [(r["left"], r["right"], r["n"]) for r in merges] == wanted
    rows = entry.queries()["tokenizer_vocabulary"](spark, "").orderBy("id").collect()
    pieces = list(dict.fromkeys(a + b for a, b, _ in wanted))
    tail = sorted(chars, key=lambda c: (-chars[c], c))
    assert [r["piece"] for r in rows] == [*CONTROL_PIECES, *pieces, *tail]


def test_candidates_that_no_longer_tell_are_counted_again(spark, monkeypatch):
    """With one listed pair every round asks anew, also where all pairs are as frequent."""
    monkeypatch.setattr(V, "CANDIDATES", 1)
    words = {"▁abab": 2, "▁ba": 2, "▁cdc": 2, "▁aaaa": 1, "▁aaa": 1}
    got = V.train_bpe(frequencies(spark, words), 12, coverage=1.0, table_every=2)
    assert [(l, r, n) for _, l, r, _, n in got] == one_at_a_time(words, 12, set("".join(words)))


def test_pieces_that_several_merges_arrive_at(spark):
    """a+bc and ab+c, with a pair of the piece learned in between."""
    words = {"abcd": 9, "xbc": 50, "yab": 30, "zabc": 12, "abce": 3, "qab": 20, "abcabc": 4}
    for every in (1, 24):
        got = V.train_bpe(frequencies(spark, words), 14, coverage=1.0, table_every=every)
        assert [(l, r, n) for _, l, r, _, n in got] == one_at_a_time(words, 14, set("".join(words)))


def test_a_round_reads_only_the_postings_of_its_seams(spark):
    words = random_words(8, "abcdef", 200)
    symbols = V.Symbols()
    numbered = V.numbered_words(frequencies(spark, words), [])
    postings = V.Postings(numbered, 2, symbols)
    rows = postings.table.collect()
    wanted = {(V.seam(a, b), w) for w in words for a, b in zip(w, w[1:])}
    assert {(r["seam"], "".join(map(chr, r["symbols"]))) for r in rows} == wanted
    plan = postings.table.where(F.col("seam").isin(*range(20)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(seam" in plan
    (_, left, right), *_ = V.Pairs(V.pair_counts(numbered, symbols, [])).top(1)[0]
    before = one_at_a_time(words, 1, set("".join(words)))
    assert (left, right) == before[0][:2]
    postings.changes([(left, right)])
    postings.compact()
    after = {w: merge_word(list(w), left, right) for w in words}
    kept = {(r["seam"], "".join(symbols.name(x) for x in r["symbols"])) for r in postings.table.collect()}
    assert kept == {(V.seam(a, b), w) for w, s in after.items() for a, b in zip(s, s[1:])}


def test_merges_in_words_at_once():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(200)]
    symbols = V.Symbols()
    merges = [("a", "a"), ("b", "aa"), ("aa", "aa"), ("a", "b"), ("ab", "ab")]
    w = V.Words(pa.array([[ord(c) for c in t] for t in texts], pa.list_(pa.int32())))
    w.merge(symbols.merges(merges))
    for i, text in enumerate(texts):
        plain = list(text)
        for left, right in merges:
            plain = merge_word(plain, left, right)
        assert [symbols.name(x) for x in w.symbols[w.owner == i].tolist()] == plain
    assert w.lists(np.ones(200, bool)).to_pylist()[7] == w.symbols[w.owner == 7].tolist()


def test_training_stores_every_word_once(spark, monkeypatch):
    """No table of the training holds more symbols than the words do, and words that are one symbol go."""
    words = random_words(9, "abcdef", 200)
    stored = []

    def written_at(df, path, write=V.written_at):
        table = write(df, path)
        column = table.schema["symbols"].dataType.simpleString()
        stored.append(table.select(F.sum(F.length("symbols") / 4 if column == "binary" else F.size("symbols"))).first()[0] or 0)
        return table

    monkeypatch.setattr(V, "written_at", written_at)
    got = V.train_bpe(frequencies(spark, words), 12, coverage=1.0, table_every=2)
    assert [(l, r, n) for _, l, r, _, n in got] == one_at_a_time(words, 12, set("".join(words)))
    assert max(stored) <= sum(map(len, words)) and stored[-1] < stored[0]


def test_merges_whose_pair_comes_twice():
    """A word goes through merges in their order, also where a pair is merged again later."""
    import numpy as np
    import pyarrow as pa

    symbols, merges = V.Symbols(), [("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc"), ("x", "abc"), ("ab", "c"), ("a", "b"), ("ab", "c")]
    texts = ["abc", "xabc", "aabcabc", "bc", "abab", "x"]
    w = V.Words(pa.array([[ord(c) for c in t] for t in texts], pa.list_(pa.int32())))
    w.merge(symbols.merges(merges))
    for i, text in enumerate(texts):
        plain = list(text)
        for left, right in merges:
            plain = merge_word(plain, left, right)
        assert [symbols.name(x) for x in w.symbols[w.owner == i].tolist()] == plain
    found = V.packed([(w, np.arange(1, 7))])
    (kept, n), = V.unpacked(found)
    sizes = np.bincount(w.owner, minlength=6)
    assert n.tolist() == [i + 1 for i in range(6) if sizes[i] > 1]
    assert np.bincount(kept.owner).tolist() == sizes[sizes > 1].tolist()


def test_registered_training_reads_the_rows_of_its_time(spark, monkeypatch):
    """A second call in one application, over other rows of the same folder, gives their pieces."""
    found = []
    for text in ("low low lower", "new new newer"):
        df = spark.createDataFrame([(text,)], "text string")
        monkeypatch.setattr("checks.queries.S.transcripts", lambda spark, sf_dir, df=df: df)
        found.append({r["piece"] for r in entry.queries()["tokenizer_vocabulary"](spark, "twice").collect()})
    assert "▁low" in found[0] and "▁new" in found[1] and "▁low" not in found[1]
