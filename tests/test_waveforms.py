import math
import struct
import tempfile
import wave

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from speechloom.functions.waveform import (
    UnreadableAudio,
    encode_wav,
    fourier_resample,
    resampled_length,
    wav_duration,
    wav_samples,
)
from speechloom.operators import waveforms as W
from speechloom.plans.dataset_corpus import prepare_dataset_corpus
from speechloom.plans.evaluation import transcribe_directory
from speechloom.plans.local_corpus import prepare_local_corpus
from speechloom.schema import WAVEFORM
from speechloom.sources.audio_files import (
    probed_files,
    probed_headers,
    scan_audio_dir,
    union_extensions,
)
from speechloom.sources.manifests import read_split
from speechloom.streaming.manifest import manifest_rows, stream_manifest


def sine(rate, seconds, hertz=50.0):
    return np.sin(2 * np.pi * hertz * np.arange(int(rate * seconds)) / rate) * 0.5


def save_wav(path, samples, rate, width=2, channels=1):
    """With the standard library, so that the reader is checked against another writer."""
    path.parent.mkdir(parents=True, exist_ok=True)
    full = 2 ** (8 * width - 1)
    ints = np.repeat(np.round(samples * (full - 1)).astype(np.int64), channels)
    if width == 1:
        data = (ints + 128).astype(np.uint8).tobytes()
    else:
        data = b"".join(int(i).to_bytes(width, "little", signed=True) for i in ints)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(data)


@pytest.mark.parametrize("width,channels", [(1, 1), (2, 1), (2, 2), (3, 2), (4, 1)])
def test_wav_samples(tmp_path, width, channels):
    x = sine(8000, 0.25)
    save_wav(tmp_path / "a.wav", x, 8000, width, channels)
    content = pa.py_buffer((tmp_path / "a.wav").read_bytes())
    got, rate = wav_samples(content)
    assert rate == 8000 and len(got) == 2000
    assert np.abs(got - x).max() < 2.0 / 2 ** (8 * width - 1)
    assert wav_duration(content, content.size) == 0.25


def test_wav_chunks_apart_and_broken_files():
    plain = encode_wav(sine(100, 1), 100)
    extra = plain[:12] + b"LIST" + struct.pack("<I", 3) + b"abc\0" + plain[12:]
    assert wav_duration(pa.py_buffer(extra), len(extra)) == 1.0
    floats = np.array([0.25, -0.5], "<f4").tobytes()
    fmt = struct.pack("<HHIIHH", 3, 1, 100, 400, 4, 32)
    body = b"fmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", 8) + floats
    as_float = b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body
    assert wav_samples(pa.py_buffer(as_float))[0].tolist() == [0.25, -0.5]
    for broken in (b"", b"RIFF", plain[:30], b"x" * 100, plain[:12] + plain[36:]):
        assert wav_duration(pa.py_buffer(broken), len(broken)) is None
        with pytest.raises(UnreadableAudio):
            wav_samples(pa.py_buffer(broken))


def test_encode_wav_clips():
    got, _ = wav_samples(pa.py_buffer(encode_wav(np.array([2.0, -2.0, 0.0, 1.0]), 16000)))
    assert got.tolist() == [32767 / 32768, -1.0, 0.0, 32767 / 32768]


@pytest.mark.parametrize("rate,target", [(8000, 16000), (44100, 16000), (11025, 16000), (16000, 16000), (48000, 16000)])
def test_resampling_keeps_a_sine(rate, target):
    x = sine(rate, 1.0, 440.0)
    n = resampled_length(len(x), rate, target)
    assert n == math.ceil(len(x) * target / rate)
    assert np.abs(fourier_resample(x, n) - sine(target, 1.0, 440.0)[:n]).max() < 1e-6


def test_resampling_equals_direct_transform():
    rng = np.random.default_rng(0)
    for n_in, n_out in [(7, 12), (8, 12), (12, 7), (12, 8), (9, 9), (8, 16), (16, 8)]:
        x = rng.normal(size=n_in)
        m = min(n_in, n_out)
        t = np.arange(n_out) / n_out
        y = np.zeros(n_out)
        for k in range(-(m // 2), m // 2 + 1):
            weight = 0.5 if m % 2 == 0 and abs(k) == m // 2 else 1.0
            if n_out < n_in and weight == 0.5:
                weight = 1.0  # both halves of that bin are added up
            c = (x * np.exp(-2j * np.pi * k * np.arange(n_in) / n_in)).sum() / n_in
            y += weight * np.real(c * np.exp(2j * np.pi * k * t))
        assert np.abs(fourier_resample(x, n_out) - y).max() < 1e-9
    assert resampled_length(3, 44100, 16000) == 2 and resampled_length(3, 44100, 16000, round_up=False) == 1


@pytest.fixture()
def audio_dir(tmp_path):
    root = tmp_path / "audio"
    save_wav(root / "a.wav", sine(8000, 1.0), 8000)
    save_wav(root / "sub dir" / "B.WAV", sine(16000, 0.05), 16000)
    save_wav(root / "sub dir" / "deep" / "c.wav", sine(44100, 2.0), 44100, channels=2)
    (root / "bad.wav").write_bytes(b"RIFFnope")
    (root / "note.txt").write_text("x")
    (root / "mixed.Wav").write_text("x")
    return root


def test_scan_and_probe(spark, audio_dir):
    assert union_extensions([".wav", ".WAV"]) == "*{.wav,.WAV}"
    listed = scan_audio_dir(spark, str(audio_dir))
    assert "content" not in listed.columns
    paths = sorted(r["path"] for r in listed.collect())
    assert [p.removeprefix(str(audio_dir) + "/") for p in paths] == ["a.wav", "bad.wav", "sub dir/B.WAV", "sub dir/deep/c.wav"]
    wanted = dict(zip(paths, [1.0, None, 0.05, 2.0]))
    files = scan_audio_dir(spark, str(audio_dir), content=True)
    assert {r["path"]: r["measured"] for r in probed_files(files).collect()} == wanted
    assert {r["path"]: r["measured"] for r in probed_headers(listed).collect()} == wanted
    reasons = {r["path"]: (r["ok"], r["reason"]) for r in W.validate_audio_table(files, 0.1, 1.5).collect()}
    assert [reasons[p] for p in paths] == [(True, None), (False, "read_error"), (False, "too_short"), (False, "too_long")]


def test_no_files(spark, audio_dir):
    assert scan_audio_dir(spark, str(audio_dir), [".ogg"]).count() == 0
    assert transcribe_directory(spark, str(audio_dir), lambda: lambda fs: [f[-5:] for f in fs]).count() == 4


def test_resample_waveforms(spark):
    rows = [
        (0, (sine(44100, 0.5).tolist(), 44100)), (1, (sine(16000, 0.5).tolist(), 16000)), (2, (sine(8000, 0.5).tolist(), 8000)),
    ]
    df = spark.createDataFrame(rows, f"row_idx bigint, audio {WAVEFORM.simpleString()}")
    for r in W.resample_waveforms(df).collect():
        assert r["audio"]["sampling_rate"] == 16000 and r["duration"] == 0.5
        assert np.abs(np.array(r["audio"]["array"]) - sine(16000, 0.5)).max() < 1e-5


def test_large_results_are_sliced(monkeypatch):
    monkeypatch.setattr(W, "SLICE_BYTES", 100)
    rows = [b"x" * 60, None, b"y" * 60, b"z"]
    parts = list(W._in_slices(iter(rows), pa.binary(), len))
    assert [len(p) for p in parts] == [3, 1]
    assert [v.as_py() for p in parts for v in p] == rows


def test_prepare_local_corpus(spark, audio_dir, tmp_path):
    rows = [(0, "a.wav", "One!", ""), (1, "sub dir/B.WAV", "two", ""), (2, "bad.wav", "x", ""), (3, "none.wav", "x", ""), (4, "sub dir/deep/c.wav", "Three", ""), (5, "a.wav", " ", "")]
    transcripts = spark.createDataFrame(rows, "row_idx bigint, audio string, text string, duration string")
    files = scan_audio_dir(spark, str(audio_dir), content=True)
    done = prepare_local_corpus(transcripts, probed_files(files), str(tmp_path / "out"), val_fraction=0.5, base_dir=str(audio_dir), normalize=True)
    assert {r["reason"]: r["n"] for r in done["skipped"].collect()} == {"too_short": 1, "read_error": 1, "not_found": 1, "empty_text": 1}
    assert {r["split"]: r["entries"] for r in done["splits"].collect()} == {"train": 1, "val": 1}
    both = [r for s in ("train", "val") for r in read_split(spark, str(tmp_path / "out"), s).collect()]
    assert {(r["text"], r["duration"]) for r in both} == {("one", 1.0), ("three", 2.0)}

    resampled = tmp_path / "resampled"
    listed = scan_audio_dir(spark, str(audio_dir))
    done = prepare_local_corpus(transcripts, listed, str(tmp_path / "out2"), base_dir=str(audio_dir), resample_dir=str(resampled), language_tag="en-US")
    assert {r["reason"]: r["n"] for r in done["skipped"].collect()} == {"too_short": 1, "read_error": 2, "empty_text": 1}
    rows = read_split(spark, str(tmp_path / "out2"), "train").collect()
    assert {r["text"] for r in rows} == {"One! <en-US>", "Three <en-US>"}
    for r in rows:
        with wave.open(r["audio_filepath"]) as w:
            assert (w.getframerate(), w.getnchannels()) == (16000, 1)
            assert w.getnframes() == math.ceil(r["duration"] * 16000)
    with pytest.raises(ValueError, match="no valid"):
        prepare_local_corpus(transcripts.where("row_idx = 3"), probed_files(files), str(tmp_path / "out3"), base_dir=str(audio_dir))


def test_resampled_targets_must_differ(spark, audio_dir, tmp_path):
    save_wav(audio_dir / "sub dir" / "a.wav", sine(8000, 1.0), 8000)
    rows = [(0, "a.wav", "x", ""), (1, "sub dir/a.wav", "y", "")]
    transcripts = spark.createDataFrame(rows, "row_idx bigint, audio string, text string, duration string")
    files = scan_audio_dir(spark, str(audio_dir))
    with pytest.raises(ValueError, match="several files"):
        prepare_local_corpus(transcripts, files, str(tmp_path / "o"), working_dir=str(audio_dir), resample_dir=str(tmp_path / "r"))
    # files that no transcript names neither clash nor are written
    done = prepare_local_corpus(transcripts.where("row_idx = 0"), files, str(tmp_path / "o"), working_dir=str(audio_dir), resample_dir=str(tmp_path / "r"))
    assert {r["split"]: r["entries"] for r in done["splits"].collect()} == {"train": 1}
    assert [p.name for p in (tmp_path / "r").iterdir() if not p.name.startswith(".")] == ["a.wav"]


@pytest.fixture()
def dataset(spark, tmp_path):
    rows = [
        (i, (sine(rate, s).tolist() if s else None, rate), text, "val" if i % 4 == 1 else "train")
        for i, (rate, s, text) in enumerate([
            (8000, 0.5, "a"), (16000, 0.25, " b "), (16000, 0.01, "short"), (8000, None, "none"), (44100, 1.0, "c"), (16000, 1.0, " "), (22050, 0.5, "d"),
        ])
    ]
    df = spark.createDataFrame(rows, f"row_idx bigint, audio {WAVEFORM.simpleString()}, text string, split string")
    path = str(tmp_path / "dataset")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_prepare_dataset_corpus(spark, dataset, tmp_path):
    out = str(tmp_path / "corpus")
    done = prepare_dataset_corpus(dataset, out, language_tag="hi-IN", prefix_split=True, save_files=True)
    assert {(r["split"], r["reason"]): r["n"] for r in done["skipped"].collect()} == {
        ("train", "too_short"): 1, ("train", "no_array"): 1, ("val", "empty_text"): 1,
    }
    rows = {r["text"]: r for s in ("train", "val") for r in read_split(spark, out + "/manifests", s).collect()}
    assert {t: r["duration"] for t, r in rows.items()} == {"a <hi-IN>": 0.5, "b <hi-IN>": 0.25, "c <hi-IN>": 1.0, "d <hi-IN>": 0.5}
    assert rows["c <hi-IN>"]["audio_filepath"] == f"{out}/audio/train/train_00000004.wav"
    for r in rows.values():
        with wave.open(r["audio_filepath"]) as w:
            assert w.getnframes() == int(r["duration"] * 16000) and w.getframerate() == 16000
    limited = prepare_dataset_corpus(dataset, str(tmp_path / "limited"), max_samples=2)
    assert {r["split"]: r["entries"] for r in limited["splits"].collect()} == {"train": 1, "val": 1}


@pytest.mark.parametrize("split_column", [True, False])
def test_stream_equals_batch_and_restarts(spark, dataset, tmp_path, split_column):
    source = dataset if split_column else dataset.drop("split")
    folder = str(tmp_path / "source")
    source.write.parquet(folder)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    # a stream can only go by positions, which here count over both splits
    options = dict(val_fraction=0.5, max_samples=6 + split_column)

    def run():
        rows = spark.readStream.schema(source.schema).parquet(folder)
        stream_manifest(rows, out, checkpoint, "/x", **options).awaitTermination()
        columns = "row_idx bigint, audio_filepath string, text string, duration double, split string"
        table = spark.read.parquet(out + "/audio_table")
        assert table.where("(reason is null) <> (wav is not null)").count() == 0
        named = spark.read.schema(columns).json(out + "/manifest")
        assert named.join(table.where("wav is not null"), "audio_filepath", "left_anti").count() == 0
        return sorted(map(tuple, named.select("row_idx", "split", "audio_filepath", "text", "duration").collect()))

    def batch():
        return sorted(map(tuple, manifest_rows(spark.read.schema(source.schema).parquet(folder), "/x", **options).collect()))

    first = run()
    assert first == batch() and len(first) == 3 + split_column
    assert run() == first  # nothing new to read
    source.where("row_idx = 0").withColumn("row_idx", F.lit(5).cast("bigint")).write.mode("append").parquet(folder)
    assert run() == batch() and len(batch()) == 4 + split_column


def test_resampled_wavs_are_those_of_resampled_waveforms(spark):
    rows = [
        (0, (sine(44100, 0.5).tolist(), 44100)), (1, (sine(16000, 0.5).tolist(), 16000)), (2, ([0.5, -2.0, 0.25], None)),
        (3, (None, 8000)), (4, None), (5, ([], 8000)),
    ]
    df = spark.createDataFrame(rows, f"row_idx bigint, audio {WAVEFORM.simpleString()}")
    want = {r["row_idx"]: (r["wav"], r["duration"]) for r in W.resample_waveforms(df).select(
        "row_idx", "duration", W.encoded_wav(F.col("audio")).alias("wav")).collect()}
    assert {r["row_idx"]: (r["wav"], r["duration"]) for r in W.resampled_wavs(df).collect()} == want


def arrow_batches(function, *columns):
    """Sizes of the batches that an Arrow function makes of one batch."""
    parts = list(function.func(iter([columns if len(columns) > 1 else columns[0]])))
    return [part.nbytes for part in parts]


def test_many_long_waveforms_leave_python_in_small_batches():
    long = pa.array([[0.1] * 64] * 40, pa.list_(pa.float32()))
    assert max(arrow_batches(W._encoded, pa.array([[0.1] * 100_000] * 40, pa.list_(pa.float32())), pa.array([16000] * 40))) < 5 << 20
    assert max(arrow_batches(W._resampled_wav, long, pa.array([2] * 40))) < 6 << 20
    wav = W.encode_wav(np.zeros(64), 2)
    assert max(arrow_batches(W._resampled_file, pa.array([wav] * 40, pa.binary()))) < 6 << 20


def test_resample_files_query_shuffles_no_wav(spark):
    rows = [(i, [0.1 * (i % 7)] * 64) for i in range(40)]
    with tempfile.TemporaryDirectory() as folder:
        spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
        done = entry.queries()["resample_files"](spark, folder)
        assert done.count() == 40
        plan = done._jdf.queryExecution().optimizedPlan()
        join = plan
        while "Join" not in join.nodeName():
            join = join.children().apply(0)
        assert "wav" not in join.output().mkString(" ") and "_r" not in join.output().mkString(" ")
