import math

import numpy as np
import pytest

from speechloom.llm.permutation_index import Index, nearest, orders
from speechloom.llm.projection_forest import near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep bigint, score double"


def table(spark, vectors, extra=()):
    rows = [(i, [float(c) for c in v], 0, 1, 0.5) for i, v in vectors] + [(i, v, 0, 1, 0.5) for i, v in extra]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [
    (9001, None), (9002, []), (9003, [0.0] * 16), (9004, [None] + [1.0] * 15), (9005, [math.nan] + [1.0] * 15),
    (9006, [math.inf] + [1.0] * 15), (None, [1.0] * 16), (9007, [1.0, 2.0]), (9007, [1.0, 2.0]), (9020, None),
]


def groups(seed, n=400, d=16):
    """Random vectors, families around some of them, exact and scaled copies."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    for i in range(0, 120, 4):
        x[i + 1] = x[i] + 0.35 * rng.standard_normal(d)
        x[i + 2] = x[i + 1] + 0.35 * rng.standard_normal(d)
    x[200:260] = x[5]
    x[260:265] = 3 * x[6]
    x[270:300] = x[7] + 0.1 * rng.standard_normal((30, d))
    return list(enumerate(x.astype(np.float32)))


@pytest.mark.parametrize("leaf_rows,block_rows", [(768, 2048), (40, 30)])
def test_links_like_brute_force(spark, monkeypatch, leaf_rows, block_rows):
    from speechloom.llm import projection_forest

    monkeypatch.setattr(projection_forest, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(projection_forest, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(projection_forest, "LEAST_SAMPLE", 4)
    vectors = groups(3)
    rows = near_vectors(table(spark, [*vectors, vectors[0], vectors[0]], AWKWARD)).collect()
    x = np.array([v for _, v in vectors], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        low = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
        if (low == label).all():
            break
        label = low
    got = {r.vec_id: r for r in rows}
    assert len(rows) == len(vectors) + len({i for i, _ in AWKWARD})
    for i, _ in vectors:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), label[i], label[i] == i), i
    for i, _ in AWKWARD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_links_of_nothing(spark):
    assert near_vectors(table(spark, [])).collect() == []
    rows = near_vectors(table(spark, [], AWKWARD[:3])).collect()
    assert {(r.n_links, r.kept) for r in rows} == {(0, True)}


def test_footrule():
    rng = np.random.default_rng(1)
    pivots = rng.standard_normal((30, 8))
    order = orders(rng.standard_normal((50, 8)), pivots, 10)
    index = Index(order, 30)

    def places(o):
        out = np.full(30, 10)
        out[o] = np.arange(10)
        return out

    for q in range(5):
        want = [np.abs(places(order[q]) - places(o)).sum() for o in order]
        assert index.footrule(order[q]).tolist() == want


def brute_nearest(vectors, k):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float64)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        out[ids[q]] = [(ids[j], s[j]) for j in np.lexsort((ids, -s))[:min(k, len(ids) - 1)]]
    return out


def test_small_tables_are_searched_whole(spark):
    vectors = groups(4)
    rows = nearest(table(spark, [*vectors, vectors[20]], AWKWARD), k=7).collect()
    want = brute_nearest(vectors, 7)
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_of_sharded_search(spark, monkeypatch):
    from speechloom.llm import permutation_index

    monkeypatch.setattr(permutation_index, "SHARD_ROWS", 1500)
    monkeypatch.setattr(permutation_index, "BLOCK_ROWS", 64)
    x = np.random.default_rng(5).standard_normal((4000, 32))
    vectors = list(enumerate((x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)))
    rows = nearest(table(spark, vectors), k=5, share=0.2).collect()
    want = brute_nearest(vectors, 5)
    found = {(r.query_id, r.vec_id) for r in rows}
    assert len(rows) == 5 * len(want)
    assert np.mean([(q, v) in found for q, best in want.items() for v, _ in best]) >= 0.9


@pytest.mark.parametrize("norms", ["lognormal", "uniform", "few"])
def test_recall_with_varied_norms_and_several_full_shards(spark, monkeypatch, norms):
    from speechloom.llm import permutation_index

    monkeypatch.setattr(permutation_index, "SHARD_ROWS", 1500)
    rng = np.random.default_rng(6)
    n = 6000
    size = {"lognormal": rng.lognormal(0, 0.5, n), "uniform": rng.uniform(0.5, 1.5, n),
            "few": np.where(rng.random(n) < 0.1, 5.0, 1.0)}[norms]
    x = rng.standard_normal((n, 48))
    x *= (size / np.linalg.norm(x, axis=1))[:, None]
    vectors = list(enumerate(x.astype(np.float32)))
    rows = nearest(table(spark, vectors), k=4).collect()
    want = brute_nearest(vectors, 4)
    found = {(r.query_id, r.vec_id) for r in rows}
    assert np.mean([(q, v) in found for q, best in want.items() for v, _ in best]) >= 0.93


def test_fewer_candidates_than_asked(spark):
    assert nearest(table(spark, [])).collect() == []
    assert nearest(table(spark, [(20, [1.0, 0.0])])).collect() == []
    rows = nearest(table(spark, [(20, [1.0, 0.0]), (3, [0.5, 1.0]), (2, [0.5, 7.0]), (5, [-1.0, 0.0])])).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(rows, key=lambda r: r.rank)] == [(1, 2, 0.5), (2, 3, 0.5), (3, 5, -1.0)]


def linked_rows(n, d, seed=9):
    """Unit vectors of which a tenth has a partner at a cosine of about 0.9."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n - n // 10, d))
    base /= np.linalg.norm(base, axis=1)[:, None]
    near = base[:n // 10] + rng.standard_normal((n // 10, d)) * 0.45 / np.sqrt(d)
    return np.vstack([base, near / np.linalg.norm(near, axis=1)[:, None]])


@pytest.mark.parametrize("n, sampled, most", [(8000, 8000, 0.4), (20_000, 20_000, 0.25), (20_000, 256, 0.25)])
def test_forest_compares_few_pairs_and_finds_nearly_all(n, sampled, most):
    """Also where the sample ends long before the leaves are small."""
    from speechloom.llm.projection_forest import LEAF_ROWS, Forest

    x = linked_rows(n, 48)
    forest = Forest(x[np.random.default_rng(1).permutation(n)[:sampled]], n)
    leaves = forest.leaves(x)
    sizes = np.bincount(np.concatenate(leaves))
    assert bool(forest.extra) == (sampled < n) and len(sizes) <= forest.n_leaves
    assert (sizes * (sizes - 1.0)).sum() < most * n * (n - 1.0) and sizes.max() < 8 * LEAF_ROWS
    sets = [set(v) for v in leaves]
    pairs = [(i, n - n // 10 + i) for i in range(n // 10)]
    close = [(i, j) for i, j in pairs if x[i] @ x[j] >= 0.9]
    assert len(close) > 100 and np.mean([bool(sets[i] & sets[j]) for i, j in close]) >= 0.99


def test_doubles_are_compared_as_doubles(spark):
    # the cosine of (1, 2) is just under 0.9, and would be over it after a cast to float
    b = [0.9 - 1e-12, np.sqrt(1 - (0.9 - 1e-12) ** 2)]
    rows = [(1, [1.0, 0.0]), (2, [float(v) for v in b]), (3, [0.95, np.sqrt(1 - 0.95**2).item()])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    assert got == {1: 1, 2: 1, 3: 2}
