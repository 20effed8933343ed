"""Folders listed by tasks, in rounds."""

import random

import pytest
from pyspark.sql import functions as F

from speechloom.functions.paths import plain_path
from speechloom.operators.waveforms import validate_audio_table
from speechloom.sources import audio_files as A


def tree(root, rng, depth=5):
    n = 0
    for i in range(rng.randrange(1, 6)):
        (root / rng.choice([f"a{i}.wav", f"b{i}.WAV", f"c{i}.flac", f"d{i}.txt", f"_e{i}.wav", f".f{i}.mp3", f"g {i}%20#.ogg"])).write_bytes(b"x" * (i + 1))
        n += 1
    for i in range(rng.randrange(0, 4) if depth else 0):
        below = root / rng.choice([f"sub{i}", f"_hidden{i}", f".git{i}", f"x y%{i}", f"deep.wav{i}"])
        below.mkdir()
        tree(below, rng, depth - 1)


def by_driver(spark, path):
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", A.union_extensions()).load(path))
    return sorted(map(tuple, files.select(plain_path(F.col("path")), "length").collect()))


@pytest.mark.parametrize("folders", [1, 3, 256])
def test_equals_the_listing_of_the_driver(spark, tmp_path, monkeypatch, folders):
    tree(tmp_path, random.Random(11), 6)
    (tmp_path / "chain").mkdir()
    below = tmp_path / "chain"
    for i in range(12):
        below = below / f"d{i}"
        below.mkdir()
    (below / "last.wav").write_bytes(b"abc")
    monkeypatch.setattr(A, "FOLDERS", folders)
    got = sorted(map(tuple, A.scan_audio_dir(spark, str(tmp_path)).collect()))
    assert got == by_driver(spark, str(tmp_path)) and len(got) > 20
    assert sorted(map(tuple, A.scan_audio_dir(spark, f"file://{tmp_path}/chain/../").collect())) == got
    globbed = A.scan_audio_dir(spark, f"{tmp_path}/ch*")
    assert [r["length"] for r in globbed.collect()] == [3]


def test_rounds_follow_the_width_not_the_files(spark, tmp_path, monkeypatch):
    for i in range(30):
        (tmp_path / f"d{i:02d}").mkdir()
        (tmp_path / f"d{i:02d}" / "a.wav").write_bytes(b"")
    rounds = []
    plain = A.fresh_dir
    monkeypatch.setattr(A, "fresh_dir", lambda spark, purpose: rounds.append(1) or plain(spark, purpose))
    assert A.listed_files(spark, str(tmp_path)).count() == 30
    assert len(rounds) == 1
    monkeypatch.setattr(A, "FOLDERS", 10)
    assert A.listed_files(spark, str(tmp_path)).count() == 30
    assert len(rounds) == 3


def test_empty_files_are_listed_and_missing_folders_an_error(spark, tmp_path):
    (tmp_path / "empty.wav").write_bytes(b"")
    checked = validate_audio_table(A.scan_audio_dir(spark, str(tmp_path)), 0.1, 20.0).collect()
    assert [(r["ok"], r["reason"]) for r in checked] == [(False, "read_error")]
    (tmp_path / "none").mkdir()
    assert A.scan_audio_dir(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        A.scan_audio_dir(spark, str(tmp_path / "missing"))


def test_no_file_reaches_the_driver(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"x")
    plan = A.scan_audio_dir(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "LocalTableScan" not in plan
