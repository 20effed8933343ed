"""One query per operator over the given tables. Keys are those of ``oracle.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import stand_ins as S
from speechloom.functions import paths, text
from speechloom.operators import ladders, splits, vocabulary
from speechloom.operators.checkpoints import best_checkpoints
from speechloom.operators.error_rates import (
    corpus_error_rates,
    count_reference_words,
    word_alignment,
)
from speechloom.operators.folding import folded_frequencies
from speechloom.operators.joins import join_audio_files, missing_audio, pair_hypotheses
from speechloom.operators.scoring import attach_transcriptions, sample_record, spread_seconds, transcribe
from speechloom.operators.waveforms import (
    encoded_wav,
    export_audio,
    export_audio_files,
    resample_files,
    resample_waveforms,
    validate_audio_table,
)
from speechloom.plans.dataset_corpus import explain_dataset, prepare_dataset_corpus
from speechloom.plans.evaluation import evaluate_manifest, transcribe_directory
from speechloom.plans.local_corpus import explain_transcripts, prepare_local_corpus
from speechloom.plans.tokenizer import train_tokenizer
from speechloom.sources import audio_files, datasets, manifests, positions, versions
from speechloom.sources import transcripts as delimited
from speechloom.streaming.manifest import stream_manifest
from speechloom.workspace import fresh_dir, written

BPE_ROUNDS = 160  # more than the words of ``S.short_texts`` have merges, so that SQL sees the end of the training
EVERYTHING = 1 << 30
CHECKPOINTS = 5


def _explained(spark, sf_dir, **options) -> DataFrame:
    return explain_transcripts(
        S.transcripts(spark, sf_dir),
        S.audio_files(spark, sf_dir),
        shortest=S.SHORTEST,
        longest=S.LONGEST,
        base_dir=S.BASE_DIR,
        normalize=True,
        **options,
    )


def _manifest(spark, sf_dir) -> DataFrame:
    return ladders.to_manifest(_explained(spark, sf_dir), "row_idx")


def _staged_manifest(spark, sf_dir) -> DataFrame:
    """The manifest written once, for queries that read it several times."""
    return written(_manifest(spark, sf_dir), "manifest")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts joined to their files, checked, normalised and rounded."""
    return _manifest(spark, sf_dir)


# sources and sinks


def _delimited(spark, sf_dir, sep, header) -> str:
    """The transcripts as a delimited file with missing-value tokens; returns its path."""
    audio, spoken, duration = header
    rows = S.transcripts(spark, sf_dir).select(
        F.col("audio").alias(audio),
        F.when(F.col("row_idx") % 19 == 3, "NA").otherwise(F.col("text")).alias(spoken),
        F.when(F.col("row_idx") % 2 == 1, "null").otherwise(F.col("duration")).alias(duration),
    )
    out = fresh_dir(spark, "delimited")
    (
        rows.write.option("header", True).option("sep", sep).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(out)
    )
    return out


def read_transcripts(spark, sf_dir):
    path = _delimited(spark, sf_dir, ",", ("audio_path", "text", "duration"))
    return delimited.read_transcripts(spark, path, duration_column="duration", multi_line=True)


def sniff_delimiter(spark, sf_dir):
    path = _delimited(spark, sf_dir, "|", ("audio_path", "text", "duration"))
    return delimited.read_transcripts(spark, path, duration_column="duration", multi_line=True)


def resolve_column(spark, sf_dir):
    path = _delimited(spark, sf_dir, "\t", ("PATH", "Sentence", "wav"))
    return delimited.read_transcripts(spark, path, multi_line=True)


def null_tokens_to_empty(spark, sf_dir):
    cells = S.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, "N/A").when(F.col("doc_id") % 7 == 1, None)
        .otherwise(F.col("source")).alias("source"),
        F.when(F.col("doc_id") % 5 == 0, "nan").otherwise(F.col("lang")).alias("lang"),
    )
    return delimited.null_tokens_to_empty(cells)


def with_row_idx(spark, sf_dir):
    """Positions given to text lines read back from a file are a run from 0 without gaps."""
    out = fresh_dir(spark, "lines")
    S.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string")).write.text(out)
    rows = positions.with_row_idx(spark.read.text(out))
    return rows.agg(
        F.count("*").alias("n"),
        F.count_distinct("row_idx").alias("positions"),
        F.min("row_idx").alias("first"),
        F.max("row_idx").alias("last"),
    )


def write_manifest(spark, sf_dir):
    out = fresh_dir(spark, "manifest")
    manifests.write_manifest(splits.exact_split(_staged_manifest(spark, sf_dir), 0.1), out)
    return manifests.union_splits(
        {s: manifests.read_manifest(spark, manifests.split_path(out, s)) for s in ("train", "val")}
    )


def read_manifest(spark, sf_dir):
    out = fresh_dir(spark, "manifest")
    _manifest(spark, sf_dir).drop("row_idx").write.option("ignoreNullFields", False).json(out)
    return manifests.read_manifest(spark, out)


def read_dataset_split(spark, sf_dir):
    out = fresh_dir(spark, "dataset")
    S.waveforms(spark, sf_dir).write.partitionBy("split").parquet(out)
    df = datasets.read_dataset_split(spark, out, "val", required=True)
    return df.select("row_idx", "text", F.size("audio.array").alias("n_samples"))


def _written_wav_files(spark, sf_dir) -> str:
    out = fresh_dir(spark, "wav-files")
    files = S.wav_files(spark, sf_dir)
    export_audio_files(
        files.select(F.concat(F.lit(out + "/"), "path").alias("audio_filepath"), F.col("content").alias("wav"))
    )
    return out


def _below(out: str):
    return F.regexp_replace("path", "^.*/speechloom-[^/]*/", "").alias("path")


def scan_audio_dir(spark, sf_dir):
    out = _written_wav_files(spark, sf_dir)
    return audio_files.sort_by_path(audio_files.scan_audio_dir(spark, out)).select(_below(out), "length")


def union_extensions(spark, sf_dir):
    """An extension in upper case and one in lower case find each file once."""
    out = _written_wav_files(spark, sf_dir)
    return audio_files.scan_audio_dir(spark, out, (".WAV", ".wav", ".txt")).select(_below(out))


def probe_wav_duration(spark, sf_dir):
    out = _written_wav_files(spark, sf_dir)
    probed = audio_files.probed_files(audio_files.scan_audio_dir(spark, out, content=True))
    return probed.select(_below(out), "measured")


def probe_wav_headers(spark, sf_dir):
    out = _written_wav_files(spark, sf_dir)
    return audio_files.probed_headers(audio_files.scan_audio_dir(spark, out)).select(_below(out), "measured")


def write_report(spark, sf_dir):
    out = fresh_dir(spark, "report")
    pairs = S.spoken_pairs(spark, sf_dir).select(
        F.col("row_id").alias("audio_filepath"), "reference", "hypothesis", F.lit(None).cast("double").alias("duration")
    )
    metrics = corpus_error_rates(pairs)
    manifests.write_report(metrics, pairs, out)
    told = spark.read.option("multiLine", True).schema(metrics.schema).json(f"{out}/metrics")
    samples = spark.read.schema(pairs.schema).json(f"{out}/samples")
    chars = samples.agg(
        F.count("*").alias("samples"),
        F.coalesce(F.sum(F.length("reference") + F.length("hypothesis")), F.lit(0)).alias("chars"),
    )
    return told.crossJoin(chars)  # one row each


def write_corpus_text(spark, sf_dir):
    out = fresh_dir(spark, "corpus-text")
    manifests.write_corpus_text(vocabulary.corpus_text(S.transcripts(spark, sf_dir)), out)
    return spark.read.text(out).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def _pcm(wav):
    """The samples of a WAV file with the usual header, as hexadecimal digits."""
    return F.hex(F.substr(wav, F.lit(45), F.octet_length(wav)))


def export_audio_query(spark, sf_dir):
    out = fresh_dir(spark, "audio-table")
    waves = S.waveforms(spark, sf_dir).where("audio.array IS NOT NULL AND audio.sampling_rate IS NOT NULL")
    name = paths.name_audio_file(F.col("row_idx"), F.col("split"))
    export_audio(waves.withColumn("audio_filepath", name), out)
    return spark.read.parquet(out).select(
        "audio_filepath",
        F.octet_length("wav").cast("bigint").alias("n_bytes"),
        audio_files.probe_wav_duration(F.col("wav")).alias("measured"),
        _pcm(F.col("wav")).alias("pcm"),
    )


def reuse_or_build(spark, sf_dir):
    out = fresh_dir(spark, "reuse")
    manifests.reuse_or_build(spark, out, lambda: splits.exact_split(_staged_manifest(spark, sf_dir), 0.1))
    return manifests.union_splits(manifests.reuse_or_build(spark, out, lambda: None, reuse=True))


def reuse_or_publish(spark, sf_dir):
    """The second build's rows, read through the pointer; the first one held other rows."""
    out = fresh_dir(spark, "versions")
    split = splits.exact_split(_staged_manifest(spark, sf_dir), 0.1)
    versions.reuse_or_publish(spark, out, lambda: split.filter("split = 'val'"))
    versions.reuse_or_publish(spark, out, lambda: split)
    return manifests.union_splits(versions.reuse_or_publish(spark, out, lambda: None, reuse=True))


def spread_seconds_query(spark, sf_dir):
    """Rows and seconds over all tasks, and whether the longest task is near the mean."""
    spoken = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.col("n_chars") / 15).alias("duration"))
    tasks = spread_seconds(spoken, 100).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.sum("duration").alias("seconds"), F.max("duration").alias("longest"))
    near = F.max("seconds") <= 1.2 * F.avg("seconds") + F.max("longest")
    return tasks.agg(F.sum("n").alias("n"), F.round(F.sum("seconds"), 3).alias("seconds"), near.alias("near"))


def read_local_manifests(spark, sf_dir):
    out = fresh_dir(spark, "local")
    manifests.write_manifest(splits.exact_split(_staged_manifest(spark, sf_dir), 0.1), out)
    both = manifests.read_local_manifests(
        spark, manifests.split_path(out, "train"), manifests.split_path(out, "val")
    )
    return splits.dataset_counts(manifests.union_splits(both))


# expressions


def strip_text(spark, sf_dir):
    padded = F.concat(F.lit(" \n"), "text", F.lit("\t "))
    return S.transcripts(spark, sf_dir).select("row_idx", text.strip_text(padded).alias("text"))


def drop_empty_text(spark, sf_dir):
    return ladders.drop_empty_text(S.transcripts(spark, sf_dir)).select("row_idx")


def guard_text(spark, sf_dir):
    waves = S.waveforms(spark, sf_dir)
    return waves.select("row_idx", ladders.guard_text(waves, "text").alias("text"))


def normalize_text(spark, sf_dir):
    return S.transcripts(spark, sf_dir).select("row_idx", text.normalize_text(F.col("text")).alias("text"))


def append_language_tag(spark, sf_dir):
    tagged = text.append_language_tag(F.col("text"), S.language_tag())
    return S.table(spark, sf_dir, "documents").select("doc_id", tagged.alias("text"))


def resolve_audio_path(spark, sf_dir):
    doc_id = F.col("doc_id")
    given = (
        F.when(doc_id % 4 == 0, F.concat(F.lit("/abs/./x//"), "source", F.lit("/../"), "lang", F.lit(".wav")))
        .when(doc_id % 4 == 1, F.concat(F.lit("../up/"), "lang", F.lit(".wav")))
        .otherwise(F.concat("source", F.lit("/"), "lang", F.lit(".wav")))
    )
    documents = S.table(spark, sf_dir, "documents")
    return documents.select("doc_id", paths.resolve_audio_path(given, "/corpus/audio").alias("audio_filepath"))


def resampled_path(spark, sf_dir):
    """The base is given in several forms."""
    given = F.concat(F.lit("/corpus/audio/"), "source", F.lit("/"), "lang", F.lit(".v1.flac"))
    bases = ("/corpus/audio", "audio/", "file:///corpus/./x/../audio", "./audio/.")
    form = F.lit(None).cast("string")
    for i, base in enumerate(bases):
        target = paths.resampled_path(given, "/out/resampled", base, "/corpus")
        form = F.when(F.col("doc_id") % len(bases) == i, target).otherwise(form)
    return S.table(spark, sf_dir, "documents").select("doc_id", form.alias("audio_filepath"))


def name_audio_file(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select(
        "doc_id",
        paths.name_audio_file(F.col("doc_id")).alias("plain"),
        paths.name_audio_file(F.col("doc_id"), F.col("lang"), "flac").alias("prefixed"),
    )


def duration_of_waveform(spark, sf_dir):
    waves = S.waveforms(spark, sf_dir)
    return waves.select("row_idx", ladders.duration_of_waveform(waves).alias("duration"))


def embedded_audio(spark, sf_dir):
    """Dataset rows whose audio is a file in a column: durations from headers, reasons before decoding."""
    rows = explain_dataset(S.embedded_files(spark, sf_dir))
    return rows.select("row_idx", ladders.duration_of_waveform(rows).alias("duration"), "reason")


def within_duration(spark, sf_dir):
    seconds = F.col("n_chars") / F.lit(50.0)
    return S.table(spark, sf_dir, "documents").select(
        "doc_id", ladders.within_duration(seconds, S.SHORTEST, S.LONGEST).alias("ok")
    )


def override_duration(spark, sf_dir):
    rows = S.transcripts(spark, sf_dir).withColumn("measured", F.col("row_idx") / F.lit(8.0))
    return rows.select(
        "row_idx", ladders.override_duration(F.col("duration"), F.col("measured")).alias("duration")
    )


def round_duration(spark, sf_dir):
    return S.table(spark, sf_dir, "events").select("event_id", ladders.round_duration(F.col("value") / 7).alias("duration"))


def skip_reason_local(spark, sf_dir):
    return _explained(spark, sf_dir).select("row_idx", "audio_filepath", "reason", F.round("duration", 6).alias("duration"))


def skip_reason_local_resampled(spark, sf_dir):
    return _explained(spark, sf_dir, resampled=True).select("row_idx", "reason")


def skip_reason_dataset(spark, sf_dir):
    return explain_dataset(S.waveforms(spark, sf_dir)).select("row_idx", "reason")


def skip_reason_dataset_compact(spark, sf_dir):
    explained = explain_dataset(S.waveforms(spark, sf_dir))
    return explained.select("row_idx", ladders.skip_reason_dataset_compact(F.col("reason")).alias("reason"))


def corpus_text(spark, sf_dir):
    return vocabulary.corpus_text(S.transcripts(spark, sf_dir))


def checkpoint_name(spark, sf_dir):
    return S.table(spark, sf_dir, "events").select(
        "event_id", paths.checkpoint_name(F.col("event_id"), F.col("value")).alias("name")
    )


# joins


def join_audio_files_query(spark, sf_dir):
    rows = S.transcripts(spark, sf_dir).withColumn(
        "audio_filepath", paths.resolve_audio_path(F.col("audio"), S.BASE_DIR)
    )
    return join_audio_files(rows, S.audio_files(spark, sf_dir)).select(
        "row_idx", "audio_filepath", "measured", "found"
    )


def missing_audio_query(spark, sf_dir):
    rows = S.transcripts(spark, sf_dir).select(
        "row_idx", paths.resolve_audio_path(F.col("audio"), S.BASE_DIR).alias("audio_filepath")
    )
    return missing_audio(rows, S.audio_files(spark, sf_dir)).select("row_idx", "audio_filepath")


def pair_hypotheses_query(spark, sf_dir):
    pairs = S.spoken_pairs(spark, sf_dir)
    heard = pairs.where(F.col("hypothesis") != "").select("row_id", "hypothesis")
    return pair_hypotheses(pairs.select("row_id", "reference"), heard, "row_id", keep_missing=True)


# aggregations


def skip_summary(spark, sf_dir):
    return ladders.skip_summary(_explained(spark, sf_dir))


def split_summary(spark, sf_dir):
    return splits.split_summary(splits.exact_split(_staged_manifest(spark, sf_dir), 0.1))


def dataset_counts(spark, sf_dir):
    return splits.dataset_counts(S.waveforms(spark, sf_dir))


def count_reference_words_query(spark, sf_dir):
    return count_reference_words(S.spoken_pairs(spark, sf_dir))


def word_alignment_query(spark, sf_dir):
    counts = word_alignment(F.col("reference"), F.col("hypothesis"))
    return S.spoken_pairs(spark, sf_dir).select("row_id", counts.alias("a")).select("row_id", "a.*")


def corpus_error_rates_query(spark, sf_dir):
    return corpus_error_rates(S.spoken_pairs(spark, sf_dir))


def _frequencies(spark, sf_dir):
    return vocabulary.word_frequencies(vocabulary.corpus_text(S.transcripts(spark, sf_dir)))


def word_frequencies(spark, sf_dir):
    return _frequencies(spark, sf_dir)


def folded_frequencies_query(spark, sf_dir):
    """Half of the texts come with full-width digits and capitals, and a byte-order mark in front."""
    plain = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    wide = "".join(chr(ord(c) + 0xFEE0) for c in plain)
    text = F.col("text")
    texts = S.short_texts(spark, sf_dir).select(F.when(F.length(text) % 2 == 0, text).otherwise(
        F.concat(F.lit("\ufeff"), F.translate(text, plain, wide))).alias("text"))
    return folded_frequencies(vocabulary.corpus_text(texts))


def char_coverage(spark, sf_dir):
    return vocabulary.char_coverage(_frequencies(spark, sf_dir))


# order, sampling, sets


def first_n(spark, sf_dir):
    """Both splits have gaps in their positions."""
    return datasets.first_n(S.waveforms(spark, sf_dir), 60).select("row_idx", "text")


def exact_split(spark, sf_dir):
    return splits.exact_split(S.transcripts(spark, sf_dir).select("row_idx"), 0.1)


def hash_split(spark, sf_dir):
    return splits.hash_split(S.transcripts(spark, sf_dir).select("row_idx"), 0.1)


def sort_by_path(spark, sf_dir):
    return audio_files.sort_by_path(S.audio_files(spark, sf_dir))


def preview(spark, sf_dir):
    return splits.preview(_manifest(spark, sf_dir), 5)


def best_checkpoints_query(spark, sf_dir):
    log = S.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("epoch"), F.col("value").alias("val_wer")
    )
    return best_checkpoints(log, keep=CHECKPOINTS)


def best_checkpoints_per_run(spark, sf_dir):
    log = S.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("epoch"), F.col("value").alias("val_wer")
    )
    return best_checkpoints(log, run="run", keep=CHECKPOINTS)


def shuffle_rows(spark, sf_dir):
    return splits.shuffle_rows(_manifest(spark, sf_dir)).withColumn("key", splits.shuffle_key(F.col("row_idx"), 42))


def union_splits(spark, sf_dir):
    waves = S.waveforms(spark, sf_dir).select("row_idx", "text", "split")
    parts = {s: waves.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    return manifests.union_splits(parts)


# waveforms


def _positive_rate(spark, sf_dir):
    explained = explain_dataset(S.waveforms(spark, sf_dir))
    return explained.where(F.col("reason").isNull())


def resample_waveforms_query(spark, sf_dir):
    resampled = resample_waveforms(_positive_rate(spark, sf_dir))
    total = F.aggregate("audio.array", F.lit(0.0), lambda a, x: a + x)
    return resampled.select(
        "row_idx",
        F.size("audio.array").alias("n_samples"),
        F.round(total / F.size("audio.array"), 4).alias("level"),
        "duration",
    )


def resample_files_query(spark, sf_dir):
    """Of files that are at 16 kHz, the samples too: decoded and encoded again."""
    files = S.wav_files(spark, sf_dir)
    same = F.substr("content", F.lit(25), F.lit(4)) == F.lit(bytearray((16000).to_bytes(4, "little")))
    # resampled files may be thousands of times longer: only what is asked of them is joined
    done = resample_files(files, same.alias("same")).select(
        "path", "measured", F.octet_length("wav").cast("bigint").alias("n_bytes"),
        F.when(F.col("same"), _pcm(F.col("wav"))).alias("pcm"),
    )
    listed = files.select("path", same.alias("same"))
    return done.join(listed, "path").select("path", "measured", "n_bytes", F.when(F.col("same"), F.col("pcm")).alias("pcm"))


def validate_audio_table_query(spark, sf_dir):
    return validate_audio_table(S.wav_files(spark, sf_dir), 0.1, 20.0)


# tokenizer


_short: dict[tuple[str, str], list] = {}


def _short_training(spark, sf_dir):
    """Word counts of the short texts and all their merges, until every word is one piece; trained once."""
    words = written(vocabulary.word_frequencies(vocabulary.corpus_text(S.short_texts(spark, sf_dir))), "words")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _short:
        _short[key] = vocabulary.train_bpe(words, EVERYTHING)
    return words, _short[key]


def train_bpe(spark, sf_dir):
    return vocabulary.merges_table(spark, _short_training(spark, sf_dir)[1])


def vocabulary_query(spark, sf_dir):
    words, learned = _short_training(spark, sf_dir)
    return vocabulary.vocabulary(spark, learned, vocabulary.char_coverage(words))


def tokenizer_merges(spark, sf_dir):
    """All merges of the whole training, up to a vocabulary of 1,024."""
    return train_tokenizer(S.transcripts(spark, sf_dir))[0]


def tokenizer_vocabulary(spark, sf_dir):
    return train_tokenizer(S.transcripts(spark, sf_dir))[1]


# scoring


def _stub_scorer():
    """Stands for a recogniser: hears the file name, lowered, without the extension."""
    return lambda files: [f.rsplit("/", 1)[-1].rsplit(".", 1)[0].lower() for f in files]


def _echo_scorer():
    return lambda files: ([" ".join(f.lower().split()) for f in files],)


def transcribe_query(spark, sf_dir):
    return transcribe(S.audio_files(spark, sf_dir).select("path"), _stub_scorer, source="path")


def transcribe_directory_query(spark, sf_dir):
    out = _written_wav_files(spark, sf_dir)
    return transcribe_directory(spark, out, _stub_scorer).select(_below(out), "transcription")


def attach_transcriptions_query(spark, sf_dir):
    """Several documents of one source share a path; each path is listed once."""
    rows = S.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("/"), "lang", F.lit(".wav")).alias("audio_filepath")
    )
    return attach_transcriptions(transcribe(rows, _stub_scorer), row_id="doc_id")


def _spoken_manifest(spark, sf_dir):
    """The scorer hears the lowered text, so the path carries it."""
    return S.table(spark, sf_dir, "conversations").select(
        F.col("text").alias("audio_filepath"),
        text.collapse_spaces(F.col("text")).alias("text"),
        (F.length("text") / F.lit(50.0)).alias("duration"),
    )


def evaluate_manifest_query(spark, sf_dir):
    return evaluate_manifest(_spoken_manifest(spark, sf_dir), _echo_scorer)[0]


def sample_record_query(spark, sf_dir):
    return sample_record(evaluate_manifest(_spoken_manifest(spark, sf_dir), _echo_scorer)[1])


# whole jobs


def prepare_local(spark, sf_dir):
    done = prepare_local_corpus(
        S.transcripts(spark, sf_dir), S.audio_files(spark, sf_dir), fresh_dir(spark, "corpus"),
        base_dir=S.BASE_DIR, shortest=S.SHORTEST, longest=S.LONGEST, normalize=True, language_tag="en-US",
    )
    skipped = done["skipped"].select(F.col("reason").alias("item"), "n")
    return skipped.unionByName(done["splits"].select(F.col("split").alias("item"), F.col("entries").alias("n")))


def local_manifest(spark, sf_dir):
    """The rows that the whole job writes, not only their number."""
    out = fresh_dir(spark, "corpus")
    prepare_local_corpus(
        S.transcripts(spark, sf_dir), S.audio_files(spark, sf_dir), out,
        base_dir=S.BASE_DIR, shortest=S.SHORTEST, longest=S.LONGEST, normalize=True,
    )
    return manifests.union_splits({s: manifests.read_split(spark, out, s).drop("split") for s in ("train", "val")})


def _prepared(spark, sf_dir, waves, **options):
    """Counters and manifest rows of a dataset job, as ``item, n``."""
    out = fresh_dir(spark, "corpus")
    done = prepare_dataset_corpus(waves, out, **options)
    skipped = done["skipped"].select(F.concat_ws(":", "split", "reason").alias("item"), "n")
    rows = {s: manifests.read_manifest(spark, manifests.split_path(f"{out}/manifests", s)) for s in ("train", "val")}
    told = manifests.union_splits(rows).groupBy(F.concat_ws(":", "split", "duration").alias("item")).agg(F.count("*").alias("n"))
    return skipped.unionByName(told)


def prepare_dataset_no_audio(spark, sf_dir):
    return _prepared(spark, sf_dir, S.waveforms(spark, sf_dir).drop("audio"))


def prepare_dataset_plain_audio(spark, sf_dir):
    return _prepared(spark, sf_dir, S.waveforms(spark, sf_dir).withColumn("audio", F.col("audio").cast("string")))


def prepare_dataset_no_rate(spark, sf_dir):
    array = F.when(F.col("audio").isNotNull(), F.struct(F.col("audio.array").alias("array")))
    return _prepared(spark, sf_dir, S.waveforms(spark, sf_dir).withColumn("audio", array), shortest=0.001)


def prepare_dataset(spark, sf_dir):
    out = fresh_dir(spark, "corpus")
    prepare_dataset_corpus(S.waveforms(spark, sf_dir), out, audio_dir="/out/audio", language_tag="hi-IN", prefix_split=True)
    both = {s: manifests.read_manifest(spark, manifests.split_path(f"{out}/manifests", s)) for s in ("train", "val")}
    return manifests.union_splits(both)


def prepare_dataset_embedded(spark, sf_dir):
    """The dataset job over files in a column, as they are stored by dataset tools."""
    out = fresh_dir(spark, "corpus")
    files = written(S.embedded_files(spark, sf_dir), "embedded")
    done = prepare_dataset_corpus(files, out, audio_dir="/out/audio", prefix_split=True)
    skipped = done["skipped"].select(
        F.lit(None).cast("string").alias("audio_filepath"), F.col("reason").alias("text"),
        F.col("n").cast("double").alias("duration"), "split")
    both = {s: manifests.read_manifest(spark, manifests.split_path(f"{out}/manifests", s)) for s in ("train", "val")}
    return manifests.union_splits(both).unionByName(skipped)


def stream_manifest_query(spark, sf_dir):
    """The dataset job as a stream over the same rows; ends when it has read what is there."""
    source = S.written_wave_dataset(spark, sf_dir)
    rows = spark.readStream.schema(source.schema).parquet(source.inputFiles()[0].rsplit("/", 1)[0])
    out = fresh_dir(spark, "stream")
    query = stream_manifest(rows.drop("split"), out, f"{out}/checkpoint", "/out/audio")
    query.awaitTermination()
    columns = "row_idx bigint, audio_filepath string, text string, duration double, split string"
    return spark.read.schema(columns).json(f"{out}/manifest").drop("batch")


QUERIES = {
    "read_transcripts": read_transcripts,
    "sniff_delimiter": sniff_delimiter,
    "resolve_column": resolve_column,
    "null_tokens_to_empty": null_tokens_to_empty,
    "with_row_idx": with_row_idx,
    "read_manifest": read_manifest,
    "read_dataset_split": read_dataset_split,
    "scan_audio_dir": scan_audio_dir,
    "write_manifest": write_manifest,
    "write_report": write_report,
    "write_corpus_text": write_corpus_text,
    "export_audio": export_audio_query,
    "reuse_or_build": reuse_or_build,
    "reuse_or_publish": reuse_or_publish,
    "read_local_manifests": read_local_manifests,
    "strip_text": strip_text,
    "drop_empty_text": drop_empty_text,
    "guard_text": guard_text,
    "normalize_text": normalize_text,
    "append_language_tag": append_language_tag,
    "resolve_audio_path": resolve_audio_path,
    "resampled_path": resampled_path,
    "name_audio_file": name_audio_file,
    "duration_of_waveform": duration_of_waveform,
    "embedded_audio": embedded_audio,
    "probe_wav_duration": probe_wav_duration,
    "probe_wav_headers": probe_wav_headers,
    "within_duration": within_duration,
    "override_duration": override_duration,
    "round_duration": round_duration,
    "skip_reason_local": skip_reason_local,
    "skip_reason_local_resampled": skip_reason_local_resampled,
    "skip_reason_dataset": skip_reason_dataset,
    "skip_reason_dataset_compact": skip_reason_dataset_compact,
    "manifest": manifest,
    "corpus_text": corpus_text,
    "sample_record": sample_record_query,
    "checkpoint_name": checkpoint_name,
    "join_audio_files": join_audio_files_query,
    "missing_audio": missing_audio_query,
    "pair_hypotheses": pair_hypotheses_query,
    "attach_transcriptions": attach_transcriptions_query,
    "skip_summary": skip_summary,
    "split_summary": split_summary,
    "dataset_counts": dataset_counts,
    "count_reference_words": count_reference_words_query,
    "word_alignment": word_alignment_query,
    "corpus_error_rates": corpus_error_rates_query,
    "word_frequencies": word_frequencies,
    "folded_frequencies": folded_frequencies_query,
    "char_coverage": char_coverage,
    "first_n": first_n,
    "exact_split": exact_split,
    "hash_split": hash_split,
    "sort_by_path": sort_by_path,
    "preview": preview,
    "best_checkpoints": best_checkpoints_query,
    "best_checkpoints_per_run": best_checkpoints_per_run,
    "shuffle_rows": shuffle_rows,
    "union_extensions": union_extensions,
    "union_splits": union_splits,
    "resample_waveforms": resample_waveforms_query,
    "resample_files": resample_files_query,
    "validate_audio_table": validate_audio_table_query,
    "train_bpe": train_bpe,
    "vocabulary": vocabulary_query,
    "spread_seconds": spread_seconds_query,
    "transcribe": transcribe_query,
    "transcribe_directory": transcribe_directory_query,
    "evaluate_manifest": evaluate_manifest_query,
    "prepare_local_corpus": prepare_local,
    "prepare_local_manifest": local_manifest,
    "prepare_dataset_corpus": prepare_dataset,
    "prepare_dataset_no_audio": prepare_dataset_no_audio,
    "prepare_dataset_plain_audio": prepare_dataset_plain_audio,
    "prepare_dataset_no_rate": prepare_dataset_no_rate,
    "prepare_dataset_embedded": prepare_dataset_embedded,
    "stream_manifest": stream_manifest_query,
}

# SQL is too slow for these; tests hold them against plain training
WITHOUT_SQL = {
    "tokenizer_merges": tokenizer_merges,
    "tokenizer_vocabulary": tokenizer_vocabulary,
}
