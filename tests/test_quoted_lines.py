"""Quoted cells with line breaks, parsed by several tasks per file."""

import random

import pytest

from speechloom.sources import quoted_lines as L
from speechloom.sources.transcripts import read_transcripts


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def table(rng, n, end="\n"):
    """Text of a file with quoted cells of every kind."""
    def cell(i):
        body = "".join(rng.choice(["word", " ", end, ",", '""', "é漢", end * 2, "x" * 50]) for _ in range(rng.randrange(0, 9)))
        plain = rng.choice(["plain", "", 'stray"quote', '5" tape', "a b", 'end"'])
        return f'"{body}"' if rng.random() < 0.6 else plain
    rows = ["audio,text,duration"]
    for i in range(n):
        if rng.random() < 0.05:
            rows.append("")
        rows.append(f'a{i}.wav,{cell(i)},{i}' if rng.random() < 0.9 else f'a{i}.wav,{cell(i)}')
    rows.append(f'last.wav,"{(" long" + end) * 400}",1')
    rows.append("end.wav,x,2")
    return end.join(rows) + end


def by_spark(spark, path):
    df = spark.read.options(sep=",", quote='"', escape='"', multiLine=True, header=True).csv(path)
    return sorted((r["audio"] or "", r["text"] or "", r["duration"] or "") for r in df.collect())


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_equals_one_task_per_file(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_bytes(table(rng, 120, end).encode())
    path = str(tmp_path)
    ends = L.split_ends(spark, path, ",")
    assert len(ends) == 3 and min(map(len, ends.values())) > 8
    assert len(L.entered_inside(ends)) > 8
    got = read_transcripts(spark, path, duration_column="duration", multi_line=True)
    assert sorted(map(tuple, got.collect())) == by_spark(spark, path)
    assert got.rdd.getNumPartitions() > 8


def test_a_cell_over_many_splits_and_an_open_quote(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(1000))
    (tmp_path / "a.csv").write_text(f'audio,text\n1,"{long}"\n2,b\n3,"open\nto the end\n')
    rows = {r["audio"]: r["text"] for r in read_transcripts(spark, str(tmp_path), multi_line=True).collect()}
    assert rows["1"] == long and rows["2"] == "b"
    assert rows["3"].strip('"').startswith("open\nto the end") and set(rows) == {"1", "2", "3"}


def test_headers_of_further_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('audio,text\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text('"audio","text"\n2,z\n')
    assert {r["audio"] for r in read_transcripts(spark, str(tmp_path), multi_line=True).collect()} == {"1", "2"}
    (tmp_path / "c.csv").write_text("text,audio\nq,3\n")
    with pytest.raises(Exception, match="header"):
        read_transcripts(spark, str(tmp_path), multi_line=True).collect()
    (tmp_path / "c.csv").write_text("audio,text\n")
    assert read_transcripts(spark, str(tmp_path), multi_line=True).count() == 2


@pytest.mark.parametrize("line,states", [
    ("a,b", (False, True)), ('"a', (True, False)), ('a"', (False, False)), ('a,"b""', (True, False)), ('"a""b",c', (False, False)),
    ('"",""', (False, True)), ('a"b"c,"', (True, True)), ('""', (False, True)), ('x","y', (True, True)), ("", (False, True)),
])
def test_states_of_a_line(line, states):
    assert (L.still_inside(line, False, ","), L.still_inside(line, True, ",")) == states
