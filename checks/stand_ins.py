"""Speech-shaped tables derived by Spark from the given tables.

The given tables hold no audio. Documents stand for transcripts, labels for the listing of audio
files, embeddings for waveforms and conversation turns for reference texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.functions.text import words
from speechloom.operators.waveforms import encoded_wav
from speechloom.workspace import written

BASE_DIR = "/corpus"
SHORTEST, LONGEST = 2.0, 20.0

# Language tags for the languages of the documents.
TAGS = {"en": "en-US", "de": "de-DE", "fr": "fr-FR", "es": "es-ES"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _audio(doc_id: str = "doc_id"):
    return F.concat(F.lit("audio/"), F.lpad(F.col(doc_id).cast("string"), 8, "0"), F.lit(".wav"))


def language_tag():
    return F.element_at(F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv]), F.col("lang"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_idx, audio, text, duration``; some rows get a blank text, path or a bad duration."""
    doc_id = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc_id.alias("row_idx"),
        F.when(doc_id % 41 == 5, "").otherwise(_audio()).alias("audio"),
        F.when(doc_id % 37 == 0, "   ").when(doc_id % 53 == 0, " ?! ").otherwise(F.col("text")).alias("text"),
        F.when(doc_id % 11 == 0, "abc")
        .when(doc_id % 3 == 0, (F.col("n_chars") / F.lit(30.0)).cast("string"))
        .otherwise("")
        .alias("duration"),
    )


def short_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text`` of few different words, as many as there are rows: kinds of orders, parts, customers and events."""
    columns = (("orders", "o_orderpriority"), ("part", "p_type"), ("customer", "c_mktsegment"), ("events", "event_type"))
    parts = [table(spark, sf_dir, name).select(F.col(column).alias("text")) for name, column in columns]
    return reduce(DataFrame.unionByName, parts)


def audio_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, measured``: labelled documents have a file, unreadable where the quality is 0."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").select(
        F.concat(F.lit(BASE_DIR + "/"), _audio()).alias("path"),
        F.when(F.col("quality") != 0, F.col("n_chars") / F.lit(50.0)).alias("measured"),
    )


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_idx, audio, text, split``: rates by position, some without rate or samples."""
    vec_id = F.col("vec_id")
    rate = F.when(vec_id % 4 == 1, 2).when(vec_id % 4 == 2, 100).when(vec_id % 4 == 3, 16000)
    array = F.when(vec_id % 17 != 0, F.col("embedding"))
    audio = F.when(vec_id % 23 != 4, F.struct(array.alias("array"), rate.alias("sampling_rate")))
    embeddings = table(spark, sf_dir, "embeddings").select(
        vec_id.alias("row_idx"), audio.alias("audio"), F.when(vec_id % 5 == 1, "val").otherwise("train").alias("split")
    )
    text = F.when(F.col("doc_id") % 29 == 0, "").when(F.col("doc_id") % 31 == 0, " \n").otherwise(F.col("text"))
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"), text.alias("text"))
    return embeddings.join(documents, "row_idx").select("row_idx", "audio", "text", "split")


def embedded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The waveforms as files in the rows: WAV, heads of FLAC, some cut off, some without bytes."""
    id_ = F.col("row_idx")
    rate = F.when(id_ % 4 == 0, 80).otherwise(F.coalesce("audio.sampling_rate", F.lit(80)))
    wav = encoded_wav(F.struct(F.coalesce("audio.array", F.array().cast("array<float>")).alias("array"), rate.alias("sampling_rate")))
    packed = F.lit(16000) * F.lit(1 << 44) + F.lit((1 << 41) + (15 << 36)) + id_ * 100
    flac = F.unhex(F.concat(
        F.lit("664C614380000022" + "10001000" + "00" * 6), F.lpad(F.hex(packed), 16, "0"), F.lit("00" * 16)))
    content = (
        F.when(id_ % 19 == 6, flac).when(id_ % 13 == 0, F.substring("wav", 1, 30))
        .when(F.col("audio.array").isNotNull(), F.col("wav")))
    name = F.concat(F.lit("clips/"), id_.cast("string"), F.lit(".wav"))
    rows = waveforms(spark, sf_dir).withColumn("wav", wav)
    file = F.when(F.col("audio").isNotNull(), F.struct(content.alias("bytes"), name.alias("path")))
    return rows.select("row_idx", file.alias("audio"), "text", "split")


def wav_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, length, content``: a WAV file per embedding; some are cut off in the header."""
    vec_id = F.col("vec_id")
    rate = F.when(vec_id % 4 == 0, 8000).when(vec_id % 4 == 1, 2).when(vec_id % 4 == 2, 100).otherwise(16000)
    audio = F.struct(F.col("embedding").alias("array"), rate.alias("sampling_rate"))
    folder = F.concat(F.lit("part"), (vec_id % 3).cast("string"), F.lit("/"))
    suffix = F.when(vec_id % 7 == 0, ".WAV").when(vec_id % 7 == 1, ".txt").otherwise(".wav")
    path = F.concat(folder, F.lpad(vec_id.cast("string"), 8, "0"), suffix)
    wav = table(spark, sf_dir, "embeddings").select(vec_id, path.alias("path"), encoded_wav(audio).alias("wav"))
    content = F.when(vec_id % 13 == 0, F.substring("wav", 1, 30)).otherwise(F.col("wav"))
    return wav.select(
        "path", F.octet_length(content).cast("bigint").alias("length"), content.alias("content")
    )


def spoken_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, reference, hypothesis``: turns with words dropped, changed and put in."""
    spoken = words(F.col("text"))
    heard = F.filter(
        F.transform(
            F.col("w"),
            lambda w, i: F.when(i % 7 == 3, None)
            .when(i % 5 == 2, F.reverse(F.lower(w)))
            .when(i % 11 == 6, F.concat(w, F.lit(" um")))
            .otherwise(w),
        ),
        lambda w: w.isNotNull(),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", spoken.alias("w"))
    return turns.select(
        F.concat_ws(":", "conv_id", "turn").alias("row_id"),
        F.array_join("w", " ").alias("reference"),
        F.array_join(heard, " ").alias("hypothesis"),
    )


def written_wave_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(waveforms(spark, sf_dir), "wave")
