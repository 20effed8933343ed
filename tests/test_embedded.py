"""Audio files in dataset columns: durations from headers, MPEG frames, decoding after the filter."""

import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_audio_headers import flac, opus, vorbis

from speechloom.functions import waveform
from speechloom.functions.waveform import Ends, OutOfReach, audio_duration, encode_wav, frame_header
from speechloom.operators import embedded
from speechloom.plans.dataset_corpus import explain_dataset, prepare_dataset_corpus
from speechloom.sources.audio_files import probed_files, scan_audio_dir
from speechloom.sources.datasets import read_dataset_split
from speechloom.sources.manifests import read_split

SCHEMA = "row_idx bigint, audio struct<bytes binary, path string>, text string, split string"


def frame(bits=9, rate=0, padded=0, version=3, layer=1, mono=True, body=b""):
    """An MPEG frame of the given header fields, its body filled up with zeros."""
    head = bytes([0xFF, 0xE0 | version << 3 | layer << 1 | 1, bits << 4 | rate << 2 | padded << 1, 0xC0 if mono else 0])
    size = frame_header(head)[2]
    return (head + body).ljust(size, b"\0")


def xing(frames, name=b"Xing", **fields):
    mono, version = fields.get("mono", True), fields.get("version", 3)
    side = (17 if mono else 32) if version == 3 else (9 if mono else 17)
    return frame(body=bytes(side) + name + struct.pack(">II", 1, frames), **fields)


def vbri(frames):
    return frame(mono=False, body=bytes(32) + b"VBRI" + struct.pack(">HHHII", 1, 0, 50, 9999, frames))


TAG = b"ID3\x04\0\0\0\0\x01\x02" + bytes(130)
CASES = [
    (frame() * 100, 100 * 1152 / 44100),  # constant rate
    (frame(padded=1) * 7 + frame() * 3, 10 * 1152 / 44100),
    (b"".join(frame(bits=b) for b in (5, 9, 14, 1) * 20), 80 * 1152 / 44100),  # variable, without a table
    (xing(5000) + frame(bits=5) * 3, 5000 * 1152 / 44100),
    (xing(70, b"Info", mono=False) + frame(mono=False), 70 * 1152 / 44100),
    (xing(11, version=2, bits=8, rate=1) + frame(version=2, bits=8, rate=1), 11 * 576 / 24000),
    (vbri(321) + frame(mono=False), 321 * 1152 / 44100),
    (frame(version=0, bits=4, rate=2) * 10, 10 * 576 / 8000),
    (frame(layer=3, bits=4, rate=1) * 10, 10 * 384 / 48000),
    (frame(layer=2) * 4, 4 * 1152 / 44100),
    (TAG + frame() * 5, 5 * 1152 / 44100),
    (frame() * 5 + b"TAG" + bytes(125), 5 * 1152 / 44100),
    (frame() * 3 + b"\0junk\xff\xffjunk" + frame() * 2, 5 * 1152 / 44100),
    (frame() * 5 + frame()[:50], 5 * 1152 / 44100),  # cut off
    (frame(), 1152 / 44100),
    (frame()[:-1], None), (b"\xff\xfb\x90\xc0" + bytes(1000), None), (b"\xff\xfb\xf0\xc0" * 200, None), (b"\xff", None),
]


@pytest.mark.parametrize("content,seconds", CASES)
@pytest.mark.parametrize("block", [64, 1 << 18])
def test_mpeg_durations(content, seconds, block, monkeypatch):
    monkeypatch.setattr(waveform, "MPEG_BLOCK", max(block, 1500))
    assert audio_duration(pa.BufferReader(content), len(content)) == pytest.approx(seconds)


def test_files_with_their_ends_only():
    content = bytes(range(256)) * 100
    ends = Ends(content[:1000], content[-500:], len(content))
    ends.seek(990)
    assert ends.read(10) == content[990:1000]
    ends.seek(len(content) - 500)
    assert ends.read(9999) == content[-500:] and ends.read(5) == b""
    ends.seek(999)
    with pytest.raises(OutOfReach):
        ends.read(2)


def late_wav(n, rate):
    """A WAV file with a long chunk before the samples."""
    plain = encode_wav(np.zeros(n), rate)
    note = b"LIST" + struct.pack("<I", 9000) + bytes(9000)
    return plain[:36] + note + plain[36:]


FILES = [
    (encode_wav(np.zeros(8000), 16000), 0.5), (late_wav(16000, 8000), 2.0), (flac(16000, 32000), 2.0),
    (flac(16000, 32000, TAG.replace(b"\x01\x02", b"\x7f\x00") + bytes(16256 - 130)), 2.0), (vorbis(22050, 11025), 0.5),
    (opus(48000, 312), 1.0), (frame() * 100, 100 * 1152 / 44100), (xing(5000) + frame() * 50, 5000 * 1152 / 44100),
    (b"", None), (None, None), (b"nothing of the kind", None), (encode_wav(np.zeros(8000), 16000)[:30], None),
    (b"OggS" + bytes(70_000), None),
]


def test_embedded_durations_equal_those_of_files(spark, tmp_path):
    rows = [(i, bytearray(c) if c is not None else None) for i, (c, _) in enumerate(FILES)]
    df = spark.createDataFrame(rows, "i int, content binary")
    got = {r["i"]: r["d"] for r in df.select("i", embedded.embedded_duration(F.col("content")).alias("d")).collect()}
    assert got == {i: pytest.approx(d) if d else d for i, (_, d) in enumerate(FILES)}
    for i, (c, _) in enumerate(FILES):
        if c is not None:
            (tmp_path / f"{i}.mp3").write_bytes(c)
    listed = probed_files(scan_audio_dir(spark, str(tmp_path))).collect()
    assert {int(r["path"].rsplit("/", 1)[1][:-4]): r["measured"] for r in listed} == {
        i: pytest.approx(d) if d else d for i, (c, d) in enumerate(FILES) if c is not None}


def test_whole_files_are_read_only_where_the_ends_do_not_tell(spark, monkeypatch):
    rows = [(bytearray(encode_wav(np.zeros(8000), 16000)),), (bytearray(late_wav(8000, 8000)),)]
    df = spark.createDataFrame(rows, "content binary")
    first = embedded._from_ends(F.substring("content", 1, 4096), F.lit(None).cast("binary"), F.octet_length("content"))
    assert [str(r[0]) for r in df.select(first).collect()] == ["0.5", "nan"]


def test_dataset_of_embedded_files(spark, tmp_path):
    tone = np.sin(np.arange(8000) * 0.05) * 0.5
    rows = [
        (0, (bytearray(encode_wav(tone, 8000)), "a.wav"), "one ", "train"),
        (1, (None, "b.wav"), "x", "train"), (2, None, "x", "train"),
        (3, (bytearray(b"RIFF"), "c.wav"), "x", "train"), (4, (bytearray(flac(16000, 32000)), "d.flac"), "x", "train"),
        (5, (bytearray(encode_wav(tone[:80], 8000)), "e.wav"), "x", "val"),
        (6, (bytearray(encode_wav(tone, 16000)), None), "two", "val"), (7, (bytearray(b"RIFF"), "f"), " ", "val"),
        (8, (bytearray(encode_wav(tone, 16000)), "g"), None, "val"), (9, (bytearray(flac(16000, 32000 * 16)), "d.flac"), "x", "val"),
    ]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("split").parquet(str(tmp_path / "in"))
    df = read_dataset_split(spark, str(tmp_path / "in"), "train", required=True).unionByName(
        read_dataset_split(spark, str(tmp_path / "in"), "val", required=True))
    reasons = {r["row_idx"]: r["reason"] for r in explain_dataset(df).collect()}
    assert reasons == {0: None, 1: "no_array", 2: "no_audio_col", 3: "error", 4: None, 5: "too_short", 6: None,
                       7: "empty_text", 8: "no_text", 9: "too_long"}
    out = str(tmp_path / "out")
    done = prepare_dataset_corpus(df, out, save_files=True)
    assert {(r["split"], r["reason"]): r["n"] for r in done["skipped"].collect()}["train", "error"] == 2
    rows = {r["text"]: r for s in ("train", "val") for r in read_split(spark, out + "/manifests", s).collect()}
    assert {t: r["duration"] for t, r in rows.items()} == {"one": 1.0, "two": 0.5}
    for text, n in (("one", 16000), ("two", 8000)):
        with open(rows[text]["audio_filepath"], "rb") as f:
            assert len(f.read()) == 44 + 2 * n


def test_only_valid_rows_are_decoded(spark):
    df = spark.createDataFrame([(0, (bytearray(b"x"), "a"), "", "train")], SCHEMA)
    assert embedded.is_embedded(df.schema["audio"].dataType)
    got = df.select(embedded.decoded_audio(F.col("audio.bytes")).alias("a")).first()["a"]
    assert got is None
