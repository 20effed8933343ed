import hashlib
import random
import re

import cases
import pytest

from speechloom.llm.substrings import EDGES, remove_repeats, repeated_spans


def brute(rows, span):
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = [False] * len(w)
        for i in range(len(w) - span + 1):
            key = tuple(w[i:i + span])
            if seen.setdefault(key, (doc_id, i)) != (doc_id, i):
                gone[i:i + span] = [True] * span
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[doc_id] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def tangled(seed):
    """Texts over few words: repeats overlap, branch, begin and end anywhere, and recur within one text."""
    rng = random.Random(seed)
    rows, passages = [], [cases.prose(rng, rng.randrange(5, 40), 30) for _ in range(6)]
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            if rng.random() < 0.5:
                p = rng.choice(passages).split()
                a, b = sorted((rng.randrange(len(p) + 1), rng.randrange(len(p) + 1)))
                parts.append(" ".join(p[a:b]))
            else:
                parts.append(cases.prose(rng, rng.randrange(1, 12), rng.choice((3, 3000))))
        rows.append((100 + i, rng.choice((" ", "\n\n", " \t")).join(parts), "en", "s", 1))
    rows += [(300, "a " * 50, "en", "s", 1), (301, "a " * 51, "en", "s", 1), (302, "a b " * 30, "en", "s", 1)]
    rows += [(400 + i, rows[i][1], "en", "s", 1) for i in range(0, 30, 3)]
    return rows


@pytest.mark.parametrize("seed,span,seed_words", [(1, 5, 3), (2, 8, 4), (3, 20, 10)])
def test_like_brute_force(spark, seed, span, seed_words):
    docs = cases.awkward(spark, tangled(seed))
    known = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    want = brute(known.items(), span)
    rows = remove_repeats(docs, span=span, seed_words=seed_words, keep_text=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id][:3], r.doc_id
            assert r.kept_text in (None, want[r.doc_id][3])
    assert sum(w[1] for w in want.values()) > 0


def test_spans_name_an_earlier_source(spark):
    edges = [(d, 0, s, None, f, f + 1) for d, s, f in
             [(1, 0, 10), (1, 1, 11), (1, 2, 12), (2, 5, 10), (2, 6, 11), (2, 7, 12), (3, 0, 11), (3, 1, 12), (3, 2, 99)]]
    df = spark.createDataFrame(edges, EDGES)
    spans = sorted((r.doc_id, r.start, r.length, r.source_doc, r.source_start) for r in repeated_spans(df, 4).collect())
    assert spans == [(2, 5, 6, 1, 0), (3, 0, 5, 1, 1)]


def test_empty(spark):
    assert remove_repeats(cases.empty(spark)).collect() == []


def test_several_texts_of_one_id(spark):
    a, b = cases.prose(random.Random(1), 40), cases.prose(random.Random(2), 40)
    rows = [(3, b, "en", "s", 1), (7, a, "en", "s", 1), (7, b, "en", "s", 1), (8, a + " " + b, "en", "s", 1)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, cases.SCHEMA)).collect())
    assert got == [(3, 40, 0), (7, 40, 0), (7, 40, 40), (8, 80, 80)]
