import pytest
from pyspark.sql import functions as F

from speechloom.operators import ladders
from speechloom.operators.joins import join_audio_files, missing_audio, pair_hypotheses
from speechloom.plans.dataset_corpus import explain_dataset
from speechloom.plans.local_corpus import explain_transcripts
from speechloom.schema import WAVEFORM

LOCAL = [
    # text, file state, measured, supplied, reason, duration
    ("  ", "missing", None, "", "empty_text", None),
    ("a", "missing", None, "3", "not_found", None),
    ("a", "bad", None, "3", "read_error", None),
    ("a", "ok", 0.05, "3", "too_short", None),
    ("a", "ok", 25.0, "3", "too_long", None),
    ("a", "ok", 3.0, "30", "too_long", None),
    ("a", "ok", 3.0, "0.01", "too_short", None),
    ("a", "ok", 3.0, "abc", None, 3.0),
    ("a", "ok", 3.0, "4.5678", None, 4.568),
    ("a", "ok", 3.0, "nan", None, 3.0),
    ("a", "ok", 3.0, "inf", "too_long", None),
    ("a", "ok", 0.1, "", None, 0.1),
    ("a", "ok", 20.0, "", None, 20.0),
    ("!!", "ok", 3.0, "", "empty_text", None),
]


def local_tables(spark):
    rows = [(i, f"f{i}.wav", r[0], r[3]) for i, r in enumerate(LOCAL)]
    rows.append((len(LOCAL), "", "a", ""))
    files = [(f"/d/f{i}.wav", r[2]) for i, r in enumerate(LOCAL) if r[1] != "missing"]
    return (
        spark.createDataFrame(rows, "row_idx bigint, audio string, text string, duration string"),
        spark.createDataFrame(files, "path string, measured double"),
    )


def test_local_ladder(spark):
    transcripts, files = local_tables(spark)
    explained = explain_transcripts(transcripts, files, base_dir="/d", normalize=True)
    reasons = [r["reason"] for r in explained.orderBy("row_idx").collect()]
    assert reasons == [r[4] for r in LOCAL] + ["read_error"]
    valid = ladders.to_manifest(explained, "row_idx").collect()
    assert {r["row_idx"]: r["duration"] for r in valid} == {
        i: r[5] for i, r in enumerate(LOCAL) if r[4] is None
    }
    summary = {r["reason"]: r["n"] for r in ladders.skip_summary(explained).collect()}
    assert summary == {"empty_text": 2, "not_found": 1, "read_error": 2, "too_short": 2, "too_long": 3}


def test_local_ladder_resampled(spark):
    transcripts, files = local_tables(spark)
    explained = explain_transcripts(transcripts, files, base_dir="/d", normalize=True, resampled=True)
    got = [(r["reason"], r["duration"]) for r in explained.orderBy("row_idx").collect()]
    assert got[1][0] == "read_error"  # missing file
    assert got[3] == (None, 3.0) and got[4] == (None, 3.0)  # only the supplied duration counts
    assert got[5][0] == "too_long"


def test_text_filter_is_below_the_join(spark):
    transcripts, files = local_tables(spark)
    plan = explain_transcripts(transcripts, files, base_dir="/d")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Filter")


def test_hot_paths_are_salted_without_changing_the_result(spark):
    rows = [(i, "/d/hot.wav" if i % 3 else f"/d/{i}.wav") for i in range(3000)]
    transcripts = spark.createDataFrame(rows, "row_idx bigint, audio_filepath string")
    files = spark.createDataFrame([("/d/hot.wav", 1.5), ("/d/3.wav", None)], "path string, measured double")
    salted = join_audio_files(transcripts, files, hot_rows=100)
    plain = join_audio_files(transcripts, files)
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
    assert "_salt" not in plain._jdf.queryExecution().analyzed().toString()
    key = lambda df: sorted(map(tuple, df.select("row_idx", "audio_filepath", "measured", "found").collect()), key=repr)
    assert key(salted) == key(plain)
    assert salted.where("found").count() == 2001
    assert missing_audio(transcripts, files).count() == 999
    assert missing_audio(transcripts, files, hot_rows=100).count() == 999


def test_pair_hypotheses(spark):
    refs = spark.createDataFrame([(0, "a"), (1, "b")], "row_idx bigint, reference string")
    hyps = spark.createDataFrame([(1, "x")], "row_idx bigint, hypothesis string")
    assert pair_hypotheses(refs, hyps).count() == 1
    assert pair_hypotheses(refs, hyps, keep_missing=True).where("hypothesis is null").count() == 1


DATASET = [
    (None, "a", "no_audio_col", "no_audio"),
    ((None, 16000), "a", "no_array", "no_audio"),
    ((None, 16000), None, "no_array", "no_audio"),
    ((16000, 16000), None, "no_text", "no_text"),
    ((16000, 16000), "", "no_text", "no_text"),
    ((16000, 16000), "  ", "empty_text", "no_text"),
    ((100, 16000), "a", "too_short", "too_short"),
    ((400000, 16000), "a", "too_long", "too_long"),
    ((100, None), "a", "error", "error"),
    ((100, 0), "a", "error", "error"),
    ((0, 16000), "a", "too_short", "too_short"),
    ((22050, 44100), "a", None, None),
]


@pytest.fixture()
def dataset(spark):
    rows = [
        (i, None if a is None else (None if a[0] is None else [0.0] * a[0], a[1]), t)
        for i, (a, t, _, _) in enumerate(DATASET)
    ]
    return spark.createDataFrame(rows, f"row_idx bigint, audio {WAVEFORM.simpleString()}, text string")


def test_dataset_ladder(dataset):
    explained = explain_dataset(dataset).withColumn(
        "compact", ladders.skip_reason_dataset_compact(F.col("reason"))
    )
    got = [(r["reason"], r["compact"]) for r in explained.orderBy("row_idx").collect()]
    assert got == [d[2:] for d in DATASET]


def test_dataset_ladder_by_schema(spark):
    reason = lambda df: {r["reason"] for r in explain_dataset(df).collect()}
    assert reason(spark.createDataFrame([("x", "a")], "audio string, text string")) == {"audio_not_dict"}
    assert reason(spark.createDataFrame([("a",)], "text string")) == {"no_audio_col"}
    assert reason(spark.createDataFrame([((1,), "a")], "audio struct<rate int>, text string")) == {"no_array"}
    assert reason(spark.createDataFrame([(([1.0] * 1600,), 3)], "audio struct<array array<float>>, text int")) == {"no_text"}
    assert reason(spark.createDataFrame([(([1.0] * 1600,), "a")], "audio struct<array array<float>>, text string")) == {None}
