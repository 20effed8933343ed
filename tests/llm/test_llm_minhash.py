import random
import re

import cases
import pytest

from speechloom.llm.connected import components
from speechloom.llm.minhash import drop_near_duplicates, near_duplicates

LOWER = {c: c + 32 for c in range(65, 91)}


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingle_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, shingle_set(text, width))
    ids, u = sorted(sets), Union(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u.join(a, b)
    return {i: (len(sets[i]), u.find(i)) for i in ids}


def chains(seed):
    """Families whose members drift step by step, so that not all members link with the first."""
    rng, rows = random.Random(seed), []
    for family in range(8):
        words = cases.prose(rng, 80).split()
        for member in range(9):
            rows.append((100 + family * 20 + member, " ".join(words), "en", "s", 1))
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    # one common base with members that change much: they share bands, but do not link
    base = cases.prose(rng, 60).split()
    for member in range(40):
        words = list(base)
        for at in rng.sample(range(60), 3):
            words[at] = f"other{rng.randrange(10**6)}"
        rows.append((500 + member, " ".join(words).upper(), "en", "s", 1))
    return rows


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_like_brute_force(spark, width, percent):
    docs = cases.awkward(spark, chains(width))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], width, percent)
    rows = near_duplicates(docs, width=width, percent=percent).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id), r
    assert len({v[1] for v in want.values()}) < len(want)


def test_drop_keeps_one_row_of_each_group(spark):
    docs = cases.awkward(spark, chains(1))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert ids.count(None) == 1


def test_texts_of_one_doc_id_are_judged_one_by_one(spark):
    a, b, c = (cases.prose(random.Random(i), 40) for i in (1, 2, 3))
    rows = [(3, a), (7, a), (7, b), (7, b), (8, b), (9, c), (9, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], cases.SCHEMA)
    got = sorted((r.doc_id, r.text) for r in drop_near_duplicates(docs).collect())
    assert got == sorted([(3, a), (7, b), (9, c)])


def test_empty(spark):
    assert near_duplicates(cases.empty(spark)).collect() == []
    assert drop_near_duplicates(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links += [(200 + i, 201 + i) for i in range(20)] + [(300, 300 + i) for i in range(15)] + [(7, 7), (300, 301)]
    u = Union({x for pair in links for x in pair})
    for a, b in links:
        u.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: u.find(i) for i in u.up if u.find(i) != i}


def sets_of(spark, members, strays, seed=3):
    """One component of near copies, and strays that share some or most of its shingles."""
    rng = random.Random(seed)
    base, rows = list(range(60)), []
    for i in range(members):
        rows.append((i, 0, sorted({*rng.sample(base, 57), 1000 + rng.randrange(50)})))
    for i in range(strays):
        own = rng.sample(base, rng.choice([20, 50, 58]))
        rows.append((10_000_000 + i, 10_000_000 + i, sorted({*own, *range(5000 + 10 * i, 5004 + 10 * i)})))
    rows += [(20_000_000 + i, 20_000_000 + i // 3, sorted({*range(7000, 7030), 7100 + i})) for i in range(9)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, component bigint, shingles array<bigint>")


@pytest.mark.parametrize("large", [2, 32, 1 << 20])
def test_rare_pairs_miss_no_pair_of_different_components(spark, monkeypatch, large):
    from speechloom.llm import minhash

    monkeypatch.setattr(minhash, "LARGE_GROUP", large)
    rows, sets = sets_of(spark, 150, 12)
    component = {i: c for i, c, _ in rows}
    got = {(r.a, r.b) for r in minhash.rare_pairs(sets, 80).collect()}
    assert all(a < b and component[a] != component[b] for a, b in got)
    shingles = {i: set(x) for i, _, x in rows}
    want = {(a, b) for a in shingles for b in shingles if a < b and component[a] != component[b]
            and 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])}
    assert want and want <= got


def rows_of_joins(df):
    """Runs ``df``; the rows that each join of its plan made."""
    plan, todo, made = df._jdf.queryExecution().executedPlan(), [], []
    df._jdf.queryExecution().toRdd().count()
    todo.append(plan)
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "Join" in kind:
            made.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return made


def test_rare_pairs_of_a_large_component_and_many_strays(spark):
    from speechloom.llm import minhash

    rng = random.Random(5)
    base = list(range(60))
    rows = [(i, 0, sorted({*rng.sample(base, 57), 1000 + i % 50})) for i in range(300)]
    # strays share most shingles, but too few to be similar
    rows += [(1000 + i, 1000 + i, sorted({*rng.sample(base, 49), *range(5000 + 10 * i, 5005 + 10 * i)})) for i in range(100)]
    sets = spark.createDataFrame(rows, "doc_id bigint, component bigint, shingles array<bigint>")
    assert max(rows_of_joins(minhash.rare_pairs(sets, 80)), default=0) < sum(len(x) for _, _, x in rows)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
