import math
import random

import numpy as np
import pytest

from speechloom.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, embedding array<double>, rank string, planes string"


def brute(rows, scale=256.0, every=50, positives=5, negatives=3, low=50, high=95):
    """Every score by plain multiplication."""
    known = {}
    for vec_id, label, x, *_ in rows:
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        own = (label, [math.floor(scale * v) for v in x])
        known[vec_id] = min(known.get(vec_id, own), own)
    out = set()
    for a, (label, v) in known.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), b, other) for b, (other, w) in known.items() if b != a)
        for s, b, _ in [x for x in scored if x[2] == label][:positives]:
            fitting = [(c, -t) for t, c, other in scored if other != label and low * -s <= 100 * -t <= high * -s]
            out |= {(a, b, i + 1, c, -s, t) for i, (c, t) in enumerate(fitting[:negatives])}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = [tuple(r) for r in H.hard_negatives(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def cluster_rows(seed, n, d, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d))
    return [(i, int(rng.integers(labels)), (centres[i % labels] + 0.7 * rng.normal(size=d)).tolist()) for i in range(n)]


@pytest.mark.parametrize("d", [1, 8, 13, 64])
def test_like_plain_multiplication(spark, d, monkeypatch):
    monkeypatch.setattr(H, "CHUNK_ROWS", 70)
    monkeypatch.setattr(H, "SHARD_ROWS", 90)
    monkeypatch.setattr(H, "BLOCK_ROWS", 7)
    monkeypatch.setattr(H, "ANCHORS", 3)
    rows = cluster_rows(d, 300, d)
    wanted = brute(rows, every=10)
    assert len(wanted) > 50
    assert mined(spark, rows, every=10) == wanted


def test_ties_copies_and_awkward_vectors(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, i % 3, [1.0, 1.0, 0.0, 2.0]) for i in range(40)]  # copies
    rows += [(300, 1, None), (301, None, [1.0] * 4), (302, 1, [1.0, None, 0.0, 0.0]), (303, 1, [math.nan, 0.0, 0.0, 0.0]),
             (304, 1, [math.inf, 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (305, 1, []), (306, 0, [0.0] * 4)]
    rows += [(310, 0, [3.0, 3.0]), (311, 1, [2.0] * 9), (320, 1, [-1.0] * 4)]  # of other lengths
    rows += [(10, 0, [1.0, 1.0, 0.0, 2.0]), (10, 0, [1.0, 1.0, 0.0, 2.0]), (20, 1, [9.0, 1.0, 0.0, 2.0])]  # repeated ids
    wanted = brute(rows, every=10)
    assert wanted
    assert mined(spark, rows, every=10) == wanted


def test_numbers_near_the_end_of_a_long(spark):
    rng = random.Random(5)
    rows = [(i, i % 2, [rng.choice([-1, 1]) * rng.random() * 2.0**22 for _ in range(3)]) for i in range(60)]
    assert mined(spark, rows, every=5) == brute(rows, every=5)
    far = [*rows, (100, 0, [2.0**60, 0.0, 0.0])]  # does not fit into a long
    assert mined(spark, far, every=5) == brute(rows, every=5)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) == set()
    assert mined(spark, [(50, 0, [1.0])]) == set()
    assert mined(spark, [(50, 0, [1.0]), (51, 1, [1.0])]) == set()  # no positive


def test_planes_and_tables():
    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, (50, 19))
    planes = H.pack(v, 10)
    assert planes.shape == (50, 10, 3)
    assert (H.unpack(planes, 19) == v).all()
    a = rng.integers(-300, 300, (4, 19))
    sums = H.subset_sums(a, np.int64)
    assert sums.shape == (3, 256, 4)
    assert sums[1, 0b101, 2] == a[2, 8] + a[2, 10]
    assert (H.scores(sums, planes) == v @ a.T).all()
