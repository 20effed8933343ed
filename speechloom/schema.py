"""Table shapes, skip reasons and other fixed values shared by the package."""

from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("audio_filepath", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("duration", T.DoubleType()),
])

WAVEFORM = T.StructType([
    T.StructField("array", T.ArrayType(T.FloatType())),
    T.StructField("sampling_rate", T.IntegerType()),
])

ALIGNMENT = T.StructType([
    T.StructField("substitutions", T.LongType()),
    T.StructField("deletions", T.LongType()),
    T.StructField("insertions", T.LongType()),
    T.StructField("hits", T.LongType()),
])

MERGES = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("left", T.StringType()),
    T.StructField("right", T.StringType()),
    T.StructField("piece", T.StringType()),
    T.StructField("n", T.LongType()),
])

TARGET_RATE = 16000

# Skip reasons of the dataset ladder and their compact form.
COMPACT_REASON = {
    "no_audio_col": "no_audio",
    "audio_not_dict": "no_audio",
    "no_array": "no_audio",
    "no_text": "no_text",
    "empty_text": "no_text",
    "too_short": "too_short",
    "too_long": "too_long",
    "error": "error",
}

# Column names tried in this order when a role is not named.
AUDIO_COLUMNS = ("audio_filepath", "audio_path", "audio", "path", "file", "filename", "wav")
TEXT_COLUMNS = ("text", "transcript", "sentence", "transcription", "label")

# Cell contents that the pandas CSV reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Audio file extensions looked for by default.
AUDIO_EXTENSIONS = (".wav", ".flac", ".mp3", ".ogg")

# Head of the vocabulary, ids 0 to 4.
CONTROL_PIECES = ("<pad>", "<unk>", "<s>", "</s>", "<blank>")

# Every character Python's str.strip() and str.split() take as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
