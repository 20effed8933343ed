import os
import posixpath

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechloom.functions import paths, text
from speechloom.operators.ladders import parse_duration


def values(spark, cells, expr, schema="x string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, " + schema)
    return [r[0] for r in rows.select("i", expr(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_normalize_text(spark):
    given_, wanted = zip(
        ("Hello,  World!", "hello world"),
        ("a_b-c d’e", "a_bc de"),
        ("परीक्षण", "परकषण"),
        ("?!…", ""),
        ("x y", "x y"),
        ("  tab\there\x1cnow\n", "tab here now"),
        ("½ ² Ⅷ", "½ ² ⅷ"),
        (None, None),
    )
    assert values(spark, given_, text.normalize_text) == list(wanted)
    assert values(spark, ["परीक्षण"], lambda c: text.normalize_text(c, keep_marks=True)) == ["परीक्षण"]


def test_normalize_is_idempotent_and_matches_rule(spark):
    import re

    cells = ["Ünï-çødé: 42%", "áb", "​zero", "tab\tnew\nline", "«Straße» №5", "İstanbul", "ΑΣ ΣΑ"]
    once = values(spark, cells, text.normalize_text)
    assert values(spark, once, text.normalize_text) == once
    assert once == [" ".join(re.sub(r"[^\w\s]", "", c.lower()).split()) for c in cells]


def test_normalizes_to_nothing(spark):
    cells = ["?!…", " ", "", "_", "a", "²", "\u0301", "!\u0903", "Ⓐ", "İ", None]
    for keep_marks in (False, True):
        gone = values(spark, cells, lambda c: text.normalizes_to_nothing(c, keep_marks))
        left = values(spark, cells, lambda c: text.normalize_text(c, keep_marks))
        assert gone == [None if x is None else x == "" for x in left]


def test_strip_and_words(spark):
    cells = ["　a \x1f", "  ", "", "a b  c", None]
    assert values(spark, cells, text.strip_text) == ["a", "", "", "a b  c", None]
    assert values(spark, cells, text.words) == [["a"], [], [], ["a", "b", "c"], None]


def test_language_tag(spark):
    tag = lambda t: values(spark, ["hello world"], lambda c: text.append_language_tag(c, t))[0]
    assert tag("en-US") == "hello world <en-US>"
    assert tag("") == tag(None) == "hello world"
    assert tag(F.lit(None).cast("string")) == tag(F.lit("")) == "hello world"
    assert tag(F.lit("hi-IN")) == "hello world <hi-IN>"
    assert values(spark, ["a b <hi-IN>", "a <b> c"], text.strip_language_tag) == ["a b", "a <b> c"]


def test_resolve_audio_path(spark):
    cells = ["a/b.wav", "/x/../y/./z.wav", "../up.wav", "//double.wav", "/plain/p.wav", "", "/..", "a/.hid.wav", "s3://b/k/../w.wav"]
    got = values(spark, cells, lambda c: paths.resolve_audio_path(c, "/data/audio"))
    wanted = [os.path.abspath(os.path.join("/data/audio", c)) for c in cells[:-1]] + ["s3://b/w.wav"]
    wanted[3] = "/double.wav"  # POSIX alone keeps two leading slashes
    assert got == wanted
    assert values(spark, ["a.wav"], lambda c: paths.resolve_audio_path(c, None, "/cwd")) == ["/cwd/a.wav"]


def test_resampled_path(spark):
    cells = ["/data/audio/s1/a.flac", "/data/audio/b", "/other/c.d.mp3", "/data/audio/.hid", "/data/audio/x..y"]
    got = values(spark, cells, lambda c: paths.resampled_path(c, "/out/", "/data/audio"))
    wanted = [
        posixpath.join("/out", posixpath.splitext(posixpath.relpath(c, "/data/audio"))[0] + ".wav") for c in cells
    ]
    assert got == wanted
    assert values(spark, cells[:1], lambda c: paths.resampled_path(c, "/out")) == ["/out/a.wav"]


def test_file_and_checkpoint_names(spark):
    name = lambda *a: values(spark, [7], lambda c: paths.name_audio_file(c, *a), "x bigint")[0]
    assert name() == "00000007.wav"
    assert name("train") == "train_00000007.wav"
    assert values(spark, [123456789], paths.name_audio_file, "x bigint") == ["123456789.wav"]
    row = spark.createDataFrame([(5, 0.2)], "e int, w double")
    assert row.select(paths.checkpoint_name(F.col("e"), F.col("w"))).first()[0] == "05-0.2000"
    assert row.select(paths.checkpoint_name(F.col("e"), F.col("w"), True)).first()[0] == "epoch=05-val_wer=0.2000"


@pytest.mark.parametrize("cells", [["1.5", " 2 ", "1_0", "1e2", ".5", "5.", "+3", "-1", "inf", "-Infinity"]])
def test_supplied_duration_numbers(spark, cells):
    assert values(spark, cells, parse_duration) == [float(c) for c in cells]


def test_supplied_duration_rejects(spark):
    cells = ["", "abc", "1.5d", "2f", "1__0", "_1", "0x10", "nan", "1,5", None]
    assert values(spark, cells, parse_duration) == [None] * len(cells)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n 　\x1c", max_size=8), min_size=1, max_size=20))
def test_words_match_python_split(spark, cells):
    assert values(spark, cells, text.words) == [c.split() for c in cells]
    assert values(spark, cells, text.strip_text) == [c.strip() for c in cells]
