"""Long pairs aligned in a band that is doubled until it must hold the best alignment."""

import random
import time

import numpy as np
import pytest

from speechloom.functions import edit_cost as E


def errors(rng, words, rate):
    out = []
    for w in words:
        x = rng.random()
        if x < rate / 3:
            continue
        out.append(rng.choice(["um", "x", w + "s"]) if x < 2 * rate / 3 else w)
        if 2 * rate / 3 < x < rate:
            out.append(rng.choice(["uh", w]))
    return out


def whole(a, b):
    """All cells, one pair at a time, as (edits, substitutions)."""
    row = [(j, 0) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [(i, 0)]
        for j, y in enumerate(b, 1):
            e, s = row[j - 1]
            new.append(min((e + (x != y), s + (x != y)), (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    return row[-1]


@pytest.mark.parametrize("band", [1, 2, 64])
def test_band_equals_all_cells(monkeypatch, band):
    monkeypatch.setattr(E, "BAND", band)
    rng = random.Random(band)
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randrange(0, 14))]
        b = errors(rng, a, rng.choice([0.1, 0.6])) if rng.random() < 0.5 else [rng.choice("abcd") for _ in range(rng.randrange(0, 14))]
        ids = {w: i for i, w in enumerate(sorted({*a, *b}))}
        got = E.banded_cost(np.array([ids[w] for w in a], np.int64), np.array([ids[w] for w in b], np.int64))
        assert got == whole(a, b), (a, b)


def test_long_and_short_pairs_of_a_batch(monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]
    refs = [[rng.choice(vocabulary) for _ in range(n)] for n in (0, 3, 900, 40, 1200, 700)]
    hyps = [errors(rng, r, rate) for r, rate in zip(refs, (0, 0.5, 0.1, 0, 1.0, 0.3))]
    hyps[5] = [rng.choice(vocabulary) for _ in range(300)]
    plain = E.edit_counts(refs, hyps)
    monkeypatch.setattr(E, "LONG_CELLS", 100)
    assert E.edit_counts(refs, hyps).equals(plain)


def test_a_pair_of_100_000_words():
    rng = random.Random(6)
    ref = [f"w{rng.randrange(5000)}" for _ in range(100_000)]
    hyp = errors(rng, ref, 0.01)
    cells = []
    plain = E._in_band
    try:
        E._in_band = lambda a, b, k: cells.append(2 * k + abs(len(a) - len(b)) + 1) or plain(a, b, k)
        begin = time.time()
        counts = E.edit_counts([ref], [hyp]).iloc[0]
    finally:
        E._in_band = plain
    assert max(cells) < 5000 and time.time() - begin < 60
    assert counts.substitutions + counts.deletions + counts.hits == len(ref)
    assert counts.substitutions + counts.insertions + counts.hits == len(hyp)
    assert 500 < counts.substitutions + counts.deletions + counts.insertions < 1500
