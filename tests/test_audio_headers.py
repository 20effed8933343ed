"""Durations from headers, files of any size, and paths that join in whatever form they are given."""

import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from speechloom.functions import paths, text
from speechloom.functions.waveform import audio_duration, encode_wav, fourier_resample, resampled_blocks, wav_layout
from speechloom.operators.error_rates import corpus_error_rates
from speechloom.operators.joins import join_audio_files
from speechloom.operators.waveforms import export_audio_files, validate_audio_table
from speechloom.plans.dataset_corpus import prepare_dataset_corpus
from speechloom.plans.local_corpus import explain_transcripts, prepare_local_corpus
from speechloom.sources.audio_files import file_opener, probed_files, scan_audio_dir
from speechloom.sources.manifests import read_manifest, read_split

TRANSCRIPT = "row_idx bigint, audio string, text string, duration string"


def flac(rate, samples, tag=b""):
    info = struct.pack(">HH", 4096, 4096) + bytes(6) + struct.pack(">Q", rate << 44 | 1 << 41 | 15 << 36 | samples) + bytes(16)
    return tag + b"fLaC" + bytes([0x80]) + len(info).to_bytes(3, "big") + info


def page(granule, serial, body, kind=0):
    head = b"OggS" + bytes([0, kind]) + struct.pack("<qIII", granule, serial, 0, 0)
    return head + bytes([1, len(body)]) + body


def vorbis(rate, samples):
    body = b"\x01vorbis" + struct.pack("<IBI", 0, 1, rate) + bytes(14)
    return page(0, 7, body, 2) + page(-1, 7, b"x" * 200) + page(samples, 7, b"y" * 50, 4) + page(99, 8, b"other")


def opus(samples, skip):
    return page(0, 3, b"OpusHead" + struct.pack("<BBHIhB", 1, 1, skip, 48000, 0, 0), 2) + page(samples + skip, 3, b"z", 4)


@pytest.mark.parametrize("content,seconds", [
    (flac(44100, 88200), 2.0), (flac(16000, 8000, b"ID3\x04\0\0\0\0\x01\x02" + bytes(130)), 0.5), (flac(16000, 0), None),
    (vorbis(22050, 11025), 0.5), (opus(48000, 312), 1.0), (encode_wav(np.zeros(800), 16000), 0.05),
    (b"", None), (b"OggS", None), (b"fLaC", None), (b"ID3", None), (b"OggS" + bytes(60), None), (b"nothing of the kind", None),
])
def test_durations_from_headers(content, seconds):
    assert audio_duration(pa.BufferReader(content), len(content)) == seconds


@pytest.mark.parametrize("rate", [8000, 44100, 16000, 22050])
def test_blocks_equal_the_whole(rate):
    x = np.sin(np.arange(90_000) * 0.05) * 0.4
    wav = encode_wav(x, rate)
    stream = pa.BufferReader(wav)
    layout = wav_layout(stream, len(wav))
    parts = np.concatenate(list(resampled_blocks(stream, layout, 16000, block=10_000, margin=4_000)))
    whole = np.concatenate(list(resampled_blocks(stream, layout, 16000)))
    assert len(parts) == len(whole) == -(-90_000 * 16000 // rate)
    # but for the ends, where a transform wraps around
    true = np.sin(np.arange(len(whole)) * rate / 16000 * 0.05) * 0.4
    assert np.abs(parts - true)[3000:-3000].max() < 2e-4
    assert np.abs(whole - true)[3000:-3000].max() < 2e-3
    if 90_000 * 16000 % rate == 0:
        assert np.abs(whole - fourier_resample(np.rint(x * 32768) / 32768, len(whole))).max() < 1e-3


def test_no_size_limit(spark, tmp_path):
    """A sparse file of more than 2 GB beside a small one."""
    (tmp_path / "small.wav").write_bytes(encode_wav(np.zeros(1600), 16000))
    frames = (1 << 31) // 2 + 8000
    head = encode_wav(np.zeros(0), 16000)
    with open(tmp_path / "large.wav", "wb") as f:
        f.write(head[:40] + struct.pack("<I", 2 * frames))
        f.truncate(44 + 2 * frames)
    listed = scan_audio_dir(spark, str(tmp_path))
    plan = probed_files(listed)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    got = {r["path"].rsplit("/", 1)[1]: r["measured"] for r in probed_files(listed).collect()}
    assert got == {"small.wav": 0.1, "large.wav": frames / 16000}
    checked = {r["path"].rsplit("/", 1)[1]: (r["ok"], r["reason"]) for r in validate_audio_table(listed, 0.01, 20.0).collect()}
    assert checked == {"small.wav": (True, None), "large.wav": (False, "too_long")}


@pytest.mark.parametrize("form", ["plain", "uri", "dotted", "relative"])
def test_every_form_of_base_joins(spark, tmp_path, form):
    root = tmp_path / "audio dir" / "x%20y"
    (root / "sub").mkdir(parents=True)
    (root / "sub" / "a b.wav").write_bytes(encode_wav(np.sin(np.arange(8000) / 9), 8000))
    base = {"plain": str(root), "uri": f"file://{root}", "dotted": f"{root}/sub/./..", "relative": "audio dir/x%20y"}[form]
    options = dict(base_dir=base, working_dir=str(tmp_path))
    transcripts = spark.createDataFrame([(0, "sub/a b.wav", "hi", ""), (1, f"file://{root}/sub/a b.wav", "ho", "")], TRANSCRIPT)
    listed = scan_audio_dir(spark, str(root))
    got = explain_transcripts(transcripts, probed_files(listed), **options).collect()
    assert [(r["reason"], r["duration"]) for r in got] == [(None, 1.0)] * 2
    out = tmp_path / "out"
    prepare_local_corpus(transcripts, listed, str(out), resample_dir=str(tmp_path / "r"), **options)
    rows = read_split(spark, str(out), "train").collect()
    assert {r["audio_filepath"] for r in rows} == {str(tmp_path / "r" / "sub" / "a b.wav")}
    content = (tmp_path / "r" / "sub" / "a b.wav").read_bytes()
    assert audio_duration(pa.BufferReader(content), len(content)) == 1.0


def test_paths_of_the_default_file_system(spark):
    fs = "hdfs://nn:8020"
    df = spark.createDataFrame([("hdfs://nn:8020/a/b.wav",), ("hdfs://other/a.wav",), ("c.wav",), ("/d.wav",)], "p string")
    resolve = paths.resolve_audio_path(F.col("p"), "hdfs://nn:8020/data/./x/..", default_fs=fs)
    assert [r[0] for r in df.select(resolve).collect()] == ["/a/b.wav", "hdfs://other/a.wav", "/data/c.wav", "/d.wav"]
    assert paths.absolute_dir("s3://bucket/a//b/../c/") == "s3://bucket/a/c"
    copy = paths.resampled_path(F.lit("/w/data/audio/x/a.wav"), "/out/r", "data/./audio", "/w")
    assert spark.range(1).select(copy).first()[0] == "/out/r/x/a.wav"


def test_local_names_may_hold_anything(tmp_path):
    opened = file_opener()
    for given in (f"{tmp_path}/a b%20c#?.wav", f"file://{tmp_path}/a b%20c#?.wav", f"file:{tmp_path}/a b%20c#?.wav"):
        client, name = opened(given)
        assert name == f"{tmp_path}/a b%20c#?.wav" and client.type_name == "local"


def test_repeated_listing_rows_do_not_multiply(spark):
    transcripts = spark.createDataFrame([(0, "/a"), (1, "/b")], "row_idx bigint, audio_filepath string")
    files = spark.createDataFrame([("/a", 1.0), ("/a", 1.0), ("/a", None)], "path string, measured double")
    rows = sorted(map(tuple, join_audio_files(transcripts, files).select("row_idx", "measured", "found").collect()))
    assert rows == [(0, 1.0, True), (1, None, False)]


def test_transcripts_are_scanned_once(spark, tmp_path):
    rows = [(0, "a.wav", "x", ""), (1, "", "x", ""), (2, "a.wav", " ", ""), (3, None, None, "")]
    spark.createDataFrame(rows, TRANSCRIPT).write.parquet(str(tmp_path / "t"))
    files = spark.createDataFrame([("/d/a.wav", 1.0)], "path string, measured double")
    explained = explain_transcripts(spark.read.parquet(str(tmp_path / "t")), files, base_dir="/d")
    assert explained._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    got = {r["row_idx"]: (r["reason"], r["duration"]) for r in explained.collect()}
    assert got == {0: (None, 1.0), 1: ("read_error", None), 2: ("empty_text", None), 3: ("empty_text", None)}


@pytest.mark.parametrize("case", ["no_audio", "plain_audio", "no_rate", "no_array"])
def test_dataset_of_every_schema(spark, tmp_path, case):
    audio = {
        "plain_audio": F.lit("x"), "no_array": F.struct(F.lit(1).alias("sampling_rate")),
        "no_rate": F.struct(F.array_repeat(F.lit(0.25).cast("float"), 8000).alias("array")),
    }
    df = spark.range(4).select(F.col("id").alias("row_idx"), F.lit("t").alias("text"),
                               F.when(F.col("id") % 2 == 0, "train").otherwise("val").alias("split"))
    if case in audio:
        df = df.withColumn("audio", audio[case])
    done = prepare_dataset_corpus(df, str(tmp_path / "out"))
    skipped = {(r["split"], r["reason"]): r["n"] for r in done["skipped"].collect()}
    reason = {"no_audio": "no_audio_col", "plain_audio": "audio_not_dict", "no_array": "no_array"}.get(case)
    assert skipped == ({("train", reason): 2, ("val", reason): 2} if reason else {})
    rows = [r for s in ("train", "val") for r in read_split(spark, str(tmp_path / "out" / "manifests"), s).collect()]
    assert [r["duration"] for r in rows] == ([] if reason else [0.5] * 4)


def test_required_columns_are_checked_whatever_is_asked_for(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"audio_filepath": "a", "text": "b"}\n{"audio_filepath": "a"}\n')
    for ask in (lambda df: df.count(), lambda df: df.select("audio_filepath").collect()):
        with pytest.raises(Exception, match="without text"):
            ask(read_manifest(spark, str(tmp_path / "m.json")))


def test_tags_of_any_form(spark):
    cells = ["a <sr-Cyrl-RS>", "b <es-419>", "c <hi>", "d <e>", "e <x y>", "<hi>", "f < hi>"]
    df = spark.createDataFrame([(c,) for c in cells], "t string")
    assert [r[0] for r in df.select(text.strip_language_tag(F.col("t"))).collect()] == ["a", "b", "c", "d <e>", "e <x y>", "", "f < hi>"]
    assert [r[0] for r in df.select(text.strip_language_tag(F.col("t"), "x y")).collect()][4] == "e"
    pairs = spark.createDataFrame([("a <hi>", "a <hi>"), ("<hi>", "b <hi>")], "reference string, hypothesis string")
    assert corpus_error_rates(pairs, strip_tag=True).first()["num_samples"] == 1
    assert corpus_error_rates(pairs).first()["num_samples"] == 2


def test_exported_files_are_whole(spark, tmp_path):
    rows = [(str(tmp_path / "o" / f"{i}.wav"), bytearray(encode_wav(np.zeros(i), 16000))) for i in range(20)]
    export_audio_files(spark.createDataFrame(rows, "audio_filepath string, wav binary"))
    assert {p.name: len(p.read_bytes()) for p in (tmp_path / "o").iterdir() if p.suffix == ".wav"} == {
        f"{i}.wav": 44 + 2 * i for i in range(20)}
    assert not list((tmp_path / "o").glob("*.tmp"))
