import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from speechloom.operators.splits import exact_split
from speechloom.schema import MANIFEST
from speechloom.sources import manifests, positions
from speechloom.sources.datasets import first_n, read_dataset_split
from speechloom.sources.transcripts import (
    read_transcripts,
    resolve_column,
    sniff_delimiter,
)


def put(folder, name, content):
    path = folder / name
    path.write_bytes(content.encode())
    return str(path)


@pytest.mark.parametrize("line,wanted", [("a\tb,c", "\t"), ("a,b|c", ","), ("a|b", "|"), ("a b", ",")])
def test_sniff_delimiter(spark, tmp_path, line, wanted):
    assert sniff_delimiter(spark, put(tmp_path, "t.txt", line + "\nx\ty|z,\n")) == wanted


def test_resolve_column():
    audio = ("audio_filepath", "audio_path", "audio", "path", "file", "filename", "wav")
    text = ("text", "transcript", "sentence", "transcription", "label")
    header = ["Label", "PATH", "Sentence", "wav"]
    assert header[resolve_column(header, audio, "audio")] == "PATH"
    assert header[resolve_column(header, text, "text")] == "Sentence"
    with pytest.raises(ValueError, match="audio"):
        resolve_column(["x", "text"], audio, "audio")
    header = ["Text", "TEXT", "audio"]
    assert resolve_column(header, text, "text") == 1


def test_read_transcripts_cells(spark, tmp_path):
    path = put(
        tmp_path, "t.csv",
        'audio,text,duration\na.wav,"x, ""y""",1.5\n\nb.wav,NA,null\nc.wav\nd.wav,None,N/A\ne.wav, padded ,2\n',
    )
    rows = {r["audio"]: (r["text"], r["duration"]) for r in read_transcripts(spark, path, duration_column="duration").collect()}
    assert rows == {
        "a.wav": ('x, "y"', "1.5"), "b.wav": ("", ""), "c.wav": ("", ""), "d.wav": ("", ""), "e.wav": (" padded ", "2"),
    }
    # a duration column is used only when it is named, and ignored when it does not exist
    assert {r["duration"] for r in read_transcripts(spark, path).collect()} == {""}
    assert {r["duration"] for r in read_transcripts(spark, path, duration_column="nope").collect()} == {""}


def test_read_transcripts_headers(spark, tmp_path):
    path = put(tmp_path, "same.csv", "Text,TEXT,audio\nfirst,second,a.wav\n")
    assert read_transcripts(spark, path).first()["text"] == "second"
    path = put(tmp_path, "named.csv", "audio,text,my text\na.wav,one,two\n")
    assert read_transcripts(spark, path, text_column="my text").first()["text"] == "two"
    path = put(tmp_path, "lines.tsv", 'path\tlabel\na.wav\t"one\ntwo"\n')
    assert read_transcripts(spark, path, multi_line=True).first()["text"] == "one\ntwo"


def test_read_transcripts_rejects_long_rows(spark, tmp_path):
    for name, row in (("long", "a,b,c,d\n"), ("blank", "a,b,c,\n"), ("quoted", 'a,"b,b",c,d\n')):
        path = put(tmp_path, name, "audio,text,more\n" + row)
        for multi_line in (False, True):
            with pytest.raises(Exception, match="more cells than the header"):
                read_transcripts(spark, path, multi_line=multi_line).collect()
    path = put(tmp_path, "short", 'audio,text,more\na\nb,"c,d"\n')
    for multi_line in (False, True):
        rows = read_transcripts(spark, path, multi_line=multi_line).collect()
        assert {r["audio"]: r["text"] for r in rows} == {"a": "", "b": "c,d"}
    with pytest.raises(ValueError, match="nope"):
        read_transcripts(spark, path, audio_column="nope")


def test_read_transcripts_rejects_other_headers(spark, tmp_path):
    put(tmp_path, "1.csv", "audio,text\na.wav,one\n")
    put(tmp_path, "2.csv", "text,audio\ntwo,b.wav\n")
    with pytest.raises(Exception, match="header"):
        read_transcripts(spark, str(tmp_path)).collect()


def test_with_row_idx(spark, tmp_path):
    for name, lines in (("b", ["2", "3", "4"]), ("a", ["0", "1"]), ("c", [str(i) for i in range(5, 400)])):
        put(tmp_path, name + ".txt", "".join(line + "\n" for line in lines))
    rows = positions.with_row_idx(spark.read.text(str(tmp_path))).collect()
    assert len(rows) == 400 and all(r["row_idx"] == int(r["value"]) for r in rows)


def test_with_row_idx_of_transcripts(spark, tmp_path):
    path = put(tmp_path, "t.csv", "audio,text\n" + "".join(f"{i}.wav,t{i}\n" for i in range(50)))
    rows = positions.with_row_idx(read_transcripts(spark, path)).collect()
    assert {r["row_idx"]: r["audio"] for r in rows} == {i: f"{i}.wav" for i in range(50)}


def test_with_row_idx_over_file_blocks(spark, tmp_path):
    path = put(tmp_path, "big.txt", "".join(f"{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        lines = spark.read.text(path)
        assert lines.rdd.getNumPartitions() > 5
        rows = positions.with_row_idx(lines)
        assert rows.where(F.col("row_idx") != F.col("value").cast("bigint")).count() == 0
        assert rows.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_manifest_round_trip(spark, tmp_path):
    out = str(tmp_path / "m")
    rows = [(i, f"/a/{i}.wav", f"यह {i} <hi-IN>", None if i == 3 else i / 8) for i in range(20)]
    df = spark.createDataFrame(rows, "row_idx bigint, audio_filepath string, text string, duration double")
    manifests.write_manifest(exact_split(df, 0.1), out)
    lines = [
        json.loads(line)
        for folder, _, names in os.walk(out) for n in names if n.endswith(".json")
        for line in open(os.path.join(folder, n), encoding="utf-8")
    ]
    assert all(list(e) == ["audio_filepath", "text", "duration"] for e in lines) and len(lines) == 20
    raw = "".join(open(os.path.join(f, n), encoding="utf-8").read() for f, _, ns in os.walk(out) for n in ns if n.endswith(".json"))
    assert "यह" in raw
    back = manifests.read_split(spark, out, "val").unionByName(manifests.read_split(spark, out, "train"))
    assert sorted(map(tuple, back.drop("split").collect())) == sorted(r[1:] for r in rows)
    assert back.where("split = 'val'").count() == 2


def test_manifest_rejects_bad_rows(spark, tmp_path):
    good = '{"audio_filepath": "a", "text": "b", "extra": 1}\n'
    row = manifests.read_manifest(spark, put(tmp_path, "good.json", good)).first()
    assert tuple(row) == ("a", "b", None)
    for name, line, message in (
        ("nokey", '{"audio_filepath": "a"}\n', "manifest row without text"), ("nojson", "{oops\n", "MALFORMED"),
    ):
        with pytest.raises(Exception, match=message):
            manifests.read_manifest(spark, put(tmp_path, name, good + line)).collect()


def test_reuse_or_build(spark, tmp_path):
    out = str(tmp_path / "prepared")
    with pytest.raises(FileNotFoundError):
        manifests.reuse_or_build(spark, out, lambda: None, reuse=True)
    df = spark.createDataFrame([("train", "a", "b", 1.0)], "split string, audio_filepath string, text string, duration double")
    built = manifests.reuse_or_build(spark, out, lambda: df)
    assert built["train"].count() == 1 and built["val"].count() == 0
    assert manifests.reuse_or_build(spark, out, lambda: None, reuse=True)["train"].count() == 1
    with pytest.raises(PySparkException):
        manifests.reuse_or_build(spark, out, lambda: df)


def test_read_local_manifests(spark, tmp_path):
    path = put(tmp_path, "train.json", '{"audio_filepath": "a", "text": "b", "duration": 2}\n')
    with pytest.warns(UserWarning, match="validation"):
        both = manifests.read_local_manifests(spark, path, str(tmp_path / "nope"))
    assert both["train"].count() == 1 and both["val"].count() == 0
    with pytest.raises(FileNotFoundError):
        manifests.read_local_manifests(spark, str(tmp_path / "nope"))
    with pytest.raises(ValueError):
        manifests.read_local_manifests(spark, None)


def test_read_dataset_split(spark, tmp_path):
    out = str(tmp_path / "ds")
    spark.range(10).select(F.col("id").alias("row_idx"), F.lit("train").alias("split")).write.parquet(out)
    assert read_dataset_split(spark, out, "train", max_samples=4).count() == 4
    assert read_dataset_split(spark, out, "train", max_samples=40).count() == 10
    with pytest.warns(UserWarning):
        assert read_dataset_split(spark, out, "test") is None
    with pytest.warns(UserWarning):
        assert read_dataset_split(spark, str(tmp_path / "none"), "val") is None
    with pytest.raises(ValueError):
        read_dataset_split(spark, out, "test", required=True)
    assert first_n(spark.range(3).withColumnRenamed("id", "row_idx"), 0).count() == 3
    rows = [(i, "val" if i % 3 else "train") for i in (50, 3, 7, 8, 11, 12, 30, 31)]
    gapped = spark.createDataFrame(rows, "row_idx bigint, split string")
    kept = sorted(r["row_idx"] for r in first_n(gapped, 2).collect())
    assert kept == [3, 7, 8, 12]


def test_reports_and_corpus_text(spark, tmp_path):
    samples = spark.createDataFrame([("a", "r", "h", None)], "audio_filepath string, reference string, hypothesis string, duration double")
    metrics = samples.select(F.lit(0.5).alias("wer"), F.lit(None).cast("string").alias("error"))
    out = str(tmp_path / "report")
    assert manifests.write_report(metrics, samples, out)
    document = "\n".join(r[0] for r in spark.read.text(out + "/metrics", wholetext=True).collect())
    assert json.loads(document) == {"wer": 0.5, "error": None} and "\n" in document.strip()
    assert json.loads(spark.read.text(out + "/samples").first()[0])["duration"] is None
    assert not manifests.write_report(metrics, samples.where("false"), str(tmp_path / "empty"))
    manifests.write_corpus_text(spark.createDataFrame([("a\nb",), ("c",)], "text string"), str(tmp_path / "t"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a", "b", "c"]


def test_union_splits_keeps_empty_parts(spark):
    empty = spark.createDataFrame([], MANIFEST)
    one = spark.createDataFrame([("a", "b", 1.0)], MANIFEST)
    assert manifests.union_splits({"train": one, "val": empty}).collect()[0]["split"] == "train"
