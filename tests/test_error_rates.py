import random

import pytest
from pyspark.sql import functions as F

from speechloom.functions.edit_cost import edit_counts
from speechloom.operators.error_rates import corpus_error_rates, count_reference_words, word_alignment
from speechloom.plans.evaluation import evaluate_manifest
from speechloom.schema import MANIFEST

PAIRS = [
    ("a b c", "a b c", (0, 0, 0, 3)),
    ("a b c", "", (0, 3, 0, 0)),
    ("a b c", "a x c d", (1, 0, 1, 2)),
    ("a b", "b a", (0, 1, 1, 1)),
]


def brute_force(ref, hyp):
    """Fewest edits, then fewest substitutions, by a plain table of (edits, subs) pairs."""
    table = [[(j, 0) for j in range(len(hyp) + 1)]]
    for i, r in enumerate(ref):
        row = [(i + 1, 0)]
        for j, h in enumerate(hyp):
            diagonal = table[i][j]
            diagonal = diagonal if r == h else (diagonal[0] + 1, diagonal[1] + 1)
            up, left = table[i][j + 1], row[j]
            row.append(min(diagonal, (up[0] + 1, up[1]), (left[0] + 1, left[1])))
        table.append(row)
    edits, subs = table[-1][-1]
    deletions = (edits - subs - (len(hyp) - len(ref))) // 2
    return subs, deletions, deletions + len(hyp) - len(ref), len(ref) - subs - deletions


def test_edit_counts_against_brute_force():
    rng = random.Random(1)
    side = lambda: [rng.choice("abcd") for _ in range(rng.randrange(0, 14))]
    pairs = [(side(), side()) for _ in range(1500)] + [(["x"] * 900, ["y"]), (["x"], ["y", "x"] * 500)]
    got = edit_counts([p[0] for p in pairs], [p[1] for p in pairs])
    assert list(got.itertuples(index=False, name=None)) == [brute_force(*p) for p in pairs]
    assert (got.substitutions + got.deletions + got.hits).tolist() == [len(p[0]) for p in pairs]
    assert (got.substitutions + got.insertions + got.hits).tolist() == [len(p[1]) for p in pairs]


def test_edit_counts_of_nothing():
    assert len(edit_counts([], [])) == 0
    assert edit_counts([[]], [[]]).iloc[0].tolist() == [0, 0, 0, 0]


@pytest.fixture()
def pairs(spark):
    rows = [(r, h) for r, h, _ in PAIRS] + [("  ", "noise")]
    return spark.createDataFrame(rows, "reference string, hypothesis string")


def test_word_alignment(pairs):
    got = pairs.select("reference", "hypothesis", word_alignment(F.col("reference"), F.col("hypothesis")).alias("a"))
    found = {(r["reference"], r["hypothesis"]): tuple(r["a"]) for r in got.collect()}
    assert all(found[(r, h)] == counts for r, h, counts in PAIRS)


def test_pooled_rates(pairs):
    row = corpus_error_rates(pairs).first().asDict()
    assert (row["substitutions"], row["deletions"], row["insertions"]) == (1, 4, 2)
    assert (row["num_reference_words"], row["num_samples"], row["error"]) == (11, 4, None)
    assert row["wer"] == 7 / 11 and row["mer"] == 7 / 13
    assert row["wip"] == pytest.approx(4 / 11) and row["wil"] == pytest.approx(7 / 11)
    assert count_reference_words(pairs).first()[0] == 11


def test_blank_references_only(spark):
    row = corpus_error_rates(spark.createDataFrame([(" ", "a")], "reference string, hypothesis string")).first()
    assert row["wer"] is None and row["wip"] is None and row["error"] == "No valid reference texts"


def test_no_hypothesis_words(spark):
    row = corpus_error_rates(spark.createDataFrame([("a b", None)], "reference string, hypothesis string")).first()
    assert (row["wer"], row["wip"], row["wil"]) == (1.0, 0.0, 1.0)


def test_evaluate_manifest(spark):
    rows = [(f"/a/{i}.wav", t, 1.0) for i, t in enumerate(["0 wav", "x", "  "])]

    def make_scorer():
        return lambda paths: ([p.rsplit("/", 1)[-1].replace(".", " ") for p in paths], "second")

    metrics, samples = evaluate_manifest(spark.createDataFrame(rows, MANIFEST), make_scorer)
    row = metrics.first()
    assert row["num_samples"] == 2 and row["num_reference_words"] == 3
    assert (row["substitutions"], row["deletions"], row["insertions"]) == (1, 0, 1)
    assert samples.count() == 3 and samples.columns == ["audio_filepath", "reference", "hypothesis", "duration"]


def test_strip_tag(spark):
    df = spark.createDataFrame([("a b <hi-IN>", "a b")], "reference string, hypothesis string")
    assert corpus_error_rates(df).first()["deletions"] == 1
    assert corpus_error_rates(df, strip_tag=True).first()["wer"] == 0.0
