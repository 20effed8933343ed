"""The same results in plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

from checks.queries import BPE_ROUNDS, CHECKPOINTS
from checks.stand_ins import LONGEST, SHORTEST, TAGS

# White space for trimming; the given texts hold no other kind.
_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapse(x: str) -> str:
    return _strip(rf"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def _normalize(x: str) -> str:
    return _collapse(rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}]', '', 'g')")


def _words(x: str) -> str:
    return f"list_filter(string_split({_collapse(x)}, ' '), lambda w: w <> '')"


def _wav_name(x: str) -> str:
    return f"'audio/' || lpad({x}::VARCHAR, 8, '0') || '.wav'"


def _pcm_list(samples: str, x: str) -> str:
    """16-bit samples: the upper half of 32-bit ones."""
    wide = f"least(greatest(round_even({x} * 2147483647, 0), -2147483648), 2147483647)"
    return f"list_transform({samples}, lambda x: floor({wide} / 65536)::BIGINT)"


def _hex(pcm: str) -> str:
    digits = "printf('%02X%02X', v & 255, (v >> 8) & 255)"
    return f"array_to_string(list_transform({pcm}, lambda v: {digits}), '')"


UTT = f"""
utt AS (
  SELECT doc_id AS row_idx,
    CASE WHEN doc_id % 41 = 5 THEN '' ELSE {_wav_name('doc_id')} END AS audio,
    CASE WHEN doc_id % 37 = 0 THEN '   ' WHEN doc_id % 53 = 0 THEN ' ?! ' ELSE text END AS text,
    CASE WHEN doc_id % 11 = 0 THEN 'abc' WHEN doc_id % 3 = 0 THEN (n_chars / 30.0::DOUBLE)::VARCHAR ELSE '' END AS duration
  FROM documents),
files AS (
  SELECT '/corpus/' || {_wav_name('doc_id')} AS path,
    CASE WHEN quality <> 0 THEN n_chars / 50.0::DOUBLE END AS measured
  FROM labels JOIN documents USING (doc_id)),
located AS (
  SELECT *, CASE WHEN audio = '' THEN '/corpus' ELSE '/corpus/' || audio END AS audio_filepath,
    try_cast(duration AS DOUBLE) AS supplied, {_normalize('text')} AS spoken
  FROM utt),
joined AS (
  SELECT l.*, f.measured, f.path IS NOT NULL AS found, coalesce(l.supplied, f.measured) AS d
  FROM located l LEFT JOIN files f ON l.audio_filepath = f.path)
"""


def _ladder(resampled: bool) -> str:
    measured = (
        "WHEN measured IS NULL THEN 'read_error'"
        if resampled
        else f"""WHEN audio = '' THEN 'read_error' WHEN NOT found THEN 'not_found'
             WHEN measured IS NULL THEN 'read_error'
             WHEN measured < {SHORTEST} THEN 'too_short' WHEN measured > {LONGEST} THEN 'too_long'"""
    )
    return f"""CASE WHEN {_strip('text')} = '' THEN 'empty_text' {measured}
        WHEN d < {SHORTEST} THEN 'too_short' WHEN d > {LONGEST} THEN 'too_long'
        WHEN spoken = '' THEN 'empty_text' END"""


EXPLAINED = f"""{UTT},
explained AS (SELECT *, {_ladder(False)} AS reason FROM joined),
valid AS (SELECT row_idx, audio_filepath, spoken AS text, round(d, 3) AS duration FROM explained WHERE reason IS NULL)
"""


def _split(source: str, fraction: float) -> str:
    return f"""(SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || row_idx), row_idx)
        <= floor((SELECT count(*) FROM {source}) * {fraction}::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM {source})"""


HASH_SPLIT = "CASE WHEN ('0x' || substr(md5('42:' || row_idx), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.1 THEN 'val' ELSE 'train' END"

WAVE = """
wave AS (
  SELECT vec_id AS row_idx, vec_id % 23 <> 4 AS has_audio,
    CASE WHEN vec_id % 17 <> 0 THEN embedding END AS samples,
    CASE vec_id % 4 WHEN 1 THEN 2 WHEN 2 THEN 100 WHEN 3 THEN 16000 END AS rate,
    CASE WHEN doc_id % 29 = 0 THEN '' WHEN doc_id % 31 = 0 THEN ' ' || chr(10) ELSE text END AS text,
    CASE WHEN vec_id % 5 = 1 THEN 'val' ELSE 'train' END AS split
  FROM embeddings JOIN documents ON vec_id = doc_id),
timed AS (SELECT *, CASE WHEN has_audio AND samples IS NOT NULL THEN len(samples)::DOUBLE / rate END AS d FROM wave)
"""


def _wave_ladder(compact: bool) -> str:
    pick = lambda long, short: short if compact else long
    return f"""CASE WHEN NOT has_audio THEN '{pick('no_audio_col', 'no_audio')}'
      WHEN samples IS NULL THEN '{pick('no_array', 'no_audio')}'
      WHEN text IS NULL OR text = '' THEN 'no_text'
      WHEN {_strip('text')} = '' THEN '{pick('empty_text', 'no_text')}'
      WHEN d IS NULL THEN 'error' WHEN d < 0.1 THEN 'too_short' WHEN d > 20 THEN 'too_long' END"""


WAVE_VALID = f"""{WAVE},
valid_wave AS (
  SELECT *, ceil(len(samples) * 16000::DOUBLE / rate)::BIGINT AS n_out FROM timed WHERE ({_wave_ladder(False)}) IS NULL)
"""

EMBEDDED = f"""{WAVE},
files AS (
  SELECT row_idx, has_audio, split, text, coalesce(rate, 80) AS hz, len(samples) AS n,
    CASE WHEN row_idx % 19 = 6 THEN 'flac' WHEN row_idx % 13 = 0 THEN 'cut' WHEN samples IS NOT NULL THEN 'wav' END AS samples
  FROM wave),
sized AS (
  SELECT *, CASE WHEN NOT has_audio THEN NULL WHEN samples = 'flac' THEN row_idx * 100 / 16000.0::DOUBLE
                 WHEN samples = 'wav' THEN n::DOUBLE / hz END AS d FROM files),
embedded AS (SELECT *, {_wave_ladder(False)} AS reason FROM sized)
"""

WAV_FILES = """
wav_files AS (
  SELECT vec_id, 'part' || (vec_id % 3) || '/' || lpad(vec_id::VARCHAR, 8, '0')
      || CASE vec_id % 7 WHEN 0 THEN '.WAV' WHEN 1 THEN '.txt' ELSE '.wav' END AS path,
    CASE vec_id % 4 WHEN 0 THEN 8000 WHEN 1 THEN 2 WHEN 2 THEN 100 ELSE 16000 END AS rate,
    vec_id % 13 = 0 AS cut, len(embedding) AS n, embedding AS samples
  FROM embeddings),
listed AS (SELECT * FROM wav_files WHERE vec_id % 7 <> 1)
"""

PAIRS = f"""
turns AS (SELECT conv_id || ':' || turn AS row_id, {_words('text')} AS r, text FROM conversations),
pairs AS (
  SELECT row_id, r, list_filter(string_split(array_to_string(list_filter(list_transform(r, lambda w, i:
    CASE WHEN (i - 1) % 7 = 3 THEN NULL WHEN (i - 1) % 5 = 2 THEN reverse(lower(w))
      WHEN (i - 1) % 11 = 6 THEN w || ' um' ELSE w END),
    lambda w: w IS NOT NULL), ' '), ' '), lambda w: w <> '') AS h
  FROM turns)
"""

_COST = 1 << 20


def _alignment(pairs: str) -> str:
    """Edit counts by dynamic programming, one reference word per recursion step."""
    return f"""
sized AS (SELECT row_id, r, h, len(r) AS n, len(h) AS m FROM {pairs}),
said AS (SELECT row_id, generate_subscripts(r, 1) AS i, unnest(r) AS w FROM sized),
heard AS (SELECT row_id, generate_subscripts(h, 1) AS j, unnest(h) AS w FROM sized),
dp AS (
  SELECT s.row_id, 0::BIGINT AS i, t.j, x.w, s.n, t.j * {_COST} AS v
  FROM sized s CROSS JOIN LATERAL (SELECT unnest(range(0, s.m + 1)) AS j) t
  LEFT JOIN heard x ON x.row_id = s.row_id AND x.j = t.j
  UNION ALL
  SELECT row_id, i, j, w, n,
    min(x - j * {_COST}) OVER (PARTITION BY row_id ORDER BY j ROWS UNBOUNDED PRECEDING) + j * {_COST}
  FROM (
    SELECT d.row_id, d.i + 1 AS i, d.j, d.w, d.n, least(d.v + {_COST},
      lag(d.v) OVER (PARTITION BY d.row_id ORDER BY d.j) + CASE WHEN d.w = s.w THEN 0 ELSE {_COST} + 1 END) AS x
    FROM dp d JOIN said s ON s.row_id = d.row_id AND s.i = d.i + 1
    WHERE d.i < d.n)),
best AS (
  SELECT s.row_id, s.n, s.m, d.v // {_COST} AS edits, d.v % {_COST} AS substitutions
  FROM sized s JOIN dp d ON d.row_id = s.row_id AND d.i = s.n AND d.j = s.m),
counts AS (
  SELECT row_id, substitutions, (edits - substitutions - (m - n)) // 2 AS deletions,
    (edits - substitutions - (m - n)) // 2 + m - n AS insertions,
    n - substitutions - (edits - substitutions - (m - n)) // 2 AS hits
  FROM best)
"""


_RATES = """
SELECT (s + d + i)::DOUBLE / n AS wer, (s + d + i)::DOUBLE / (n + i) AS mer,
  1 - (h::DOUBLE / n) * (h::DOUBLE / p) AS wil, (h::DOUBLE / n) * (h::DOUBLE / p) AS wip,
  s AS substitutions, d AS deletions, i AS insertions, n AS num_reference_words, k AS num_samples,
  NULL::VARCHAR AS error
FROM (SELECT *, h + s + d AS n, h + s + i AS p FROM (
  SELECT sum(substitutions)::BIGINT AS s, sum(deletions)::BIGINT AS d, sum(insertions)::BIGINT AS i,
    sum(hits)::BIGINT AS h, count(*) AS k FROM counts JOIN sized USING (row_id) WHERE sized.n > 0))
"""

SPOKEN = f"""
spoken AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) AS row_id, {_words('text')} AS r, {_words('lower(text)')} AS h,
    text, length(text) / 50.0::DOUBLE AS duration
  FROM conversations)
"""

CORPUS = f"{UTT}, corpus AS (SELECT {_strip('text')} AS text FROM utt WHERE text <> '')"

SHORT_CORPUS = f"""corpus AS (
  SELECT {_strip('text')} AS text FROM (
    SELECT o_orderpriority AS text FROM orders UNION ALL SELECT p_type FROM part
    UNION ALL SELECT c_mktsegment FROM customer UNION ALL SELECT event_type FROM events) WHERE text <> '')"""

COUNTED = f"""
freq AS (SELECT '▁' || w AS word, count(*) AS n FROM (SELECT unnest({_words('text')}) AS w FROM corpus) GROUP BY 1),
chars AS (SELECT c AS char, sum(n)::BIGINT AS n FROM (SELECT unnest(string_split(word, '')) AS c, n FROM freq) GROUP BY 1),
ranked AS (
  SELECT char, n, coalesce(sum(n) OVER (ORDER BY n DESC, char ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE
    / (SELECT sum(n) FROM chars)::DOUBLE < 0.9999::DOUBLE AS covered
  FROM chars)
"""

FREQUENCIES = f"{CORPUS},{COUNTED}"


def _merge_rounds(rounds: int) -> str:
    """Byte-pair training, one pair of CTEs per merge; they are empty once every word is one piece."""
    rare = "(SELECT coalesce(string_agg(char, '' ORDER BY char), '') FROM ranked WHERE NOT covered)"
    parts = [
        f"{SHORT_CORPUS},{COUNTED}",
        f"""t0 AS MATERIALIZED (
          SELECT chr(1) || array_to_string(string_split(translate(word, {rare}, repeat(chr(3), length({rare})::INT)), ''),
            chr(2) || chr(1)) || chr(2) AS s, n
          FROM freq)""",
    ]
    for k in range(rounds):
        parts.append(f"""m{k} AS MATERIALIZED (
          SELECT l, r, sum(n)::BIGINT AS n FROM (
            SELECT unnest(p[1:len(p) - 1]) AS l, unnest(p[2:]) AS r, n
            FROM (SELECT string_split(s[2:length(s) - 1], chr(2) || chr(1)) AS p, n FROM t{k}) WHERE len(p) > 1)
          WHERE l <> chr(3) AND r <> chr(3) GROUP BY ALL ORDER BY n DESC, l, r LIMIT 1)""")
        parts.append(f"""t{k + 1} AS MATERIALIZED (
          SELECT replace(s, chr(1) || l || chr(2) || chr(1) || r || chr(2), chr(1) || l || r || chr(2)) AS s, t{k}.n
          FROM t{k}, m{k})""")
    merges = " UNION ALL ".join(
        f'SELECT {k}::INT AS rank, l AS "left", r AS "right", l || r AS piece, n FROM m{k}' for k in range(rounds)
    )
    parts.append(f"merges AS ({merges})")
    return ",\n".join(parts)


def _best(kind: str) -> str:
    name = "printf('%02d-%.4f', epoch, val_wer) AS name"
    if kind == "run":
        part, columns = "PARTITION BY user_id", "user_id AS run, "
    else:
        part, columns = "", ""
    return f"""SELECT {columns}epoch, val_wer, {name} FROM (
      SELECT user_id, event_id AS epoch, value AS val_wer,
        row_number() OVER ({part} ORDER BY value, event_id) AS k, max(event_id) OVER ({part}) AS last
      FROM events) WHERE k <= {CHECKPOINTS} OR epoch = last"""


def _with(ctes: str, query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{query}"


def _cells(text: str, duration: str) -> str:
    return f"""SELECT audio, CASE WHEN row_idx % 19 = 3 THEN '' ELSE text END AS text, {duration} AS duration FROM utt"""


_SUPPLIED = "CASE WHEN row_idx % 2 = 1 THEN '' ELSE duration END"
_TAG = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TAGS.items()) + " END"
_SPLIT_MANIFEST = _with(EXPLAINED, f"SELECT audio_filepath, text, duration, split FROM {_split('valid', 0.1)}")
_MEASURED = "CASE WHEN cut THEN NULL ELSE n::DOUBLE / rate END"

ORACLE = {
    "read_transcripts": _with(UTT, _cells("text", _SUPPLIED)),
    "sniff_delimiter": _with(UTT, _cells("text", _SUPPLIED)),
    "resolve_column": _with(UTT, _cells("text", "''")),
    "null_tokens_to_empty": """SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 1) THEN '' ELSE source END AS source,
        CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS lang FROM documents""",
    "with_row_idx": """SELECT count(*) AS n, count(*) AS positions, 0::BIGINT AS first, count(*) - 1 AS last FROM documents""",
    "read_manifest": _with(EXPLAINED, "SELECT audio_filepath, text, duration FROM valid"),
    "read_dataset_split": _with(WAVE, """SELECT row_idx, text, CASE WHEN has_audio THEN len(samples) END::INT AS n_samples
        FROM wave WHERE split = 'val'"""),
    "scan_audio_dir": _with(WAV_FILES, "SELECT path, CASE WHEN cut THEN 30 ELSE 44 + 2 * n END::BIGINT AS length FROM listed"),
    "write_manifest": _SPLIT_MANIFEST,
    "write_report": _with(PAIRS + "," + _alignment("pairs"), f"""SELECT m.*, c.* FROM ({_RATES}) m, (
        SELECT count(*) AS samples, sum(length(array_to_string(r, ' ')) + length(array_to_string(h, ' ')))::BIGINT AS chars
        FROM pairs) c""", recursive=True),
    "write_corpus_text": _with(CORPUS, """SELECT line, count(*) AS n
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM corpus) GROUP BY line"""),
    "export_audio": _with(WAVE, f"""SELECT split || '_' || lpad(row_idx::VARCHAR, 8, '0') || '.wav' AS audio_filepath,
        (44 + 2 * len(samples))::BIGINT AS n_bytes, len(samples)::DOUBLE / rate AS measured,
        {_hex(_pcm_list('samples', 'x::DOUBLE'))} AS pcm
        FROM wave WHERE has_audio AND samples IS NOT NULL AND rate IS NOT NULL"""),
    "reuse_or_build": _SPLIT_MANIFEST,
    "reuse_or_publish": _SPLIT_MANIFEST,
    "read_local_manifests": _with(EXPLAINED, f"SELECT split, count(*) AS n FROM {_split('valid', 0.1)} GROUP BY split"),
    "strip_text": _with(UTT, f"SELECT row_idx, {_strip('text')} AS text FROM utt"),
    "drop_empty_text": _with(UTT, f"SELECT row_idx FROM utt WHERE {_strip('text')} <> ''"),
    "guard_text": _with(WAVE, "SELECT row_idx, nullif(text, '') AS text FROM wave"),
    "normalize_text": _with(UTT, f"SELECT row_idx, {_normalize('text')} AS text FROM utt"),
    "append_language_tag": f"""SELECT doc_id, CASE WHEN {_TAG} IS NULL THEN text ELSE text || ' <' || {_TAG} || '>' END AS text
        FROM documents""",
    "resolve_audio_path": """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '/abs/x/' || lang || '.wav'
        WHEN 1 THEN '/corpus/up/' || lang || '.wav' ELSE '/corpus/audio/' || source || '/' || lang || '.wav' END AS audio_filepath
        FROM documents""",
    "resampled_path": "SELECT doc_id, '/out/resampled/' || source || '/' || lang || '.v1.wav' AS audio_filepath FROM documents",
    "name_audio_file": """SELECT doc_id, printf('%08d', doc_id) || '.wav' AS plain,
        lang || '_' || printf('%08d', doc_id) || '.flac' AS prefixed FROM documents""",
    "duration_of_waveform": _with(WAVE, "SELECT row_idx, d AS duration FROM timed"),
    "probe_wav_duration": _with(WAV_FILES, f"SELECT path, {_MEASURED} AS measured FROM listed"),
    "probe_wav_headers": _with(WAV_FILES, f"SELECT path, {_MEASURED} AS measured FROM listed"),
    "embedded_audio": _with(EMBEDDED, "SELECT row_idx, d AS duration, reason FROM embedded"),
    "within_duration": f"SELECT doc_id, n_chars / 50.0::DOUBLE BETWEEN {SHORTEST} AND {LONGEST} AS ok FROM documents",
    "override_duration": _with(UTT, "SELECT row_idx, coalesce(try_cast(duration AS DOUBLE), row_idx / 8.0::DOUBLE) AS duration FROM utt"),
    "round_duration": "SELECT event_id, round(value / 7::DOUBLE, 3) AS duration FROM events",
    "skip_reason_local": _with(EXPLAINED, f"""SELECT row_idx, audio_filepath, reason,
        CASE WHEN audio = '' OR {_strip('text')} = '' THEN NULL ELSE round(d, 6) END AS duration FROM explained"""),
    "skip_reason_local_resampled": _with(UTT, f"SELECT row_idx, {_ladder(True)} AS reason FROM joined"),
    "skip_reason_dataset": _with(WAVE, f"SELECT row_idx, {_wave_ladder(False)} AS reason FROM timed"),
    "skip_reason_dataset_compact": _with(WAVE, f"SELECT row_idx, {_wave_ladder(True)} AS reason FROM timed"),
    "manifest": _with(EXPLAINED, "SELECT * FROM valid"),
    "corpus_text": _with(CORPUS, "SELECT text FROM corpus"),
    "sample_record": _with(SPOKEN, """SELECT text AS audio_filepath, array_to_string(r, ' ') AS reference,
        array_to_string(h, ' ') AS hypothesis, duration FROM spoken"""),
    "checkpoint_name": "SELECT event_id, printf('%02d-%.4f', event_id, value) AS name FROM events",
    "join_audio_files": _with(UTT, "SELECT row_idx, audio_filepath, measured, found FROM joined"),
    "missing_audio": _with(UTT, """SELECT row_idx, audio_filepath FROM located l
        WHERE NOT EXISTS (SELECT 1 FROM files f WHERE f.path = l.audio_filepath)"""),
    "pair_hypotheses": _with(PAIRS, """SELECT row_id, array_to_string(r, ' ') AS reference,
        nullif(array_to_string(h, ' '), '') AS hypothesis FROM pairs"""),
    "attach_transcriptions": """SELECT DISTINCT source || '/' || lang || '.wav' AS audio_filepath, lower(lang) AS transcription
        FROM documents""",
    "skip_summary": _with(EXPLAINED, "SELECT reason, count(*) AS n FROM explained WHERE reason IS NOT NULL GROUP BY reason"),
    "split_summary": _with(EXPLAINED, f"""SELECT *, printf('%.2f', total_ms / 3600000.0::DOUBLE) AS hours FROM (
        SELECT split, count(*) AS entries, sum(round(duration * 1000)::BIGINT)::BIGINT AS total_ms
        FROM {_split('valid', 0.1)} GROUP BY split)"""),
    "dataset_counts": _with(WAVE, "SELECT split, count(*) AS n FROM wave GROUP BY split"),
    "count_reference_words": _with(PAIRS, "SELECT sum(len(r))::BIGINT AS num_reference_words FROM pairs"),
    "word_alignment": _with(PAIRS + "," + _alignment("pairs"), "SELECT * FROM counts", recursive=True),
    "corpus_error_rates": _with(PAIRS + "," + _alignment("pairs"), _RATES, recursive=True),
    "word_frequencies": _with(FREQUENCIES, "SELECT * FROM freq"),
    "folded_frequencies": _with(f"{SHORT_CORPUS},{COUNTED}", "SELECT * FROM freq"),
    "char_coverage": _with(FREQUENCIES, "SELECT char, n FROM ranked WHERE covered"),
    "first_n": _with(WAVE, """SELECT row_idx, text FROM wave
        QUALIFY row_number() OVER (PARTITION BY split ORDER BY row_idx) <= 60"""),
    "exact_split": _with(UTT, f"SELECT row_idx, split FROM {_split('utt', 0.1)}"),
    "hash_split": _with(UTT, f"SELECT row_idx, {HASH_SPLIT} AS split FROM utt"),
    "sort_by_path": _with(UTT, "SELECT * FROM files ORDER BY path"),
    "preview": _with(EXPLAINED, "SELECT * FROM valid ORDER BY row_idx LIMIT 5"),
    "best_checkpoints": _best("all"),
    "best_checkpoints_per_run": _best("run"),
    "shuffle_rows": _with(EXPLAINED, "SELECT *, md5('42:' || row_idx) AS key FROM valid ORDER BY key"),
    "union_extensions": _with(WAV_FILES, "SELECT path FROM wav_files"),
    "union_splits": _with(WAVE, "SELECT row_idx, text, split FROM wave"),
    "resample_waveforms": _with(WAVE_VALID, """SELECT row_idx, n_out::INT AS n_samples,
        round(list_sum(samples::DOUBLE[]) / len(samples), 4) AS level, n_out / 16000.0::DOUBLE AS duration FROM valid_wave"""),
    "resample_files": _with(WAV_FILES, f"""SELECT path, CASE WHEN NOT cut THEN k / 16000.0::DOUBLE END AS measured,
        CASE WHEN NOT cut THEN 44 + 2 * k END::BIGINT AS n_bytes,
        CASE WHEN NOT cut AND rate = 16000 THEN {_hex(_pcm_list(_pcm_list('samples', 'x::DOUBLE'), 'x / 32768.0::DOUBLE'))} END AS pcm
        FROM (SELECT *, ceil(n * 16000::DOUBLE / rate)::BIGINT AS k FROM wav_files)"""),
    "validate_audio_table": _with(WAV_FILES, """SELECT path, coalesce(d BETWEEN 0.1 AND 20, false) AS ok, d AS duration,
        CASE WHEN d IS NULL THEN 'read_error' WHEN d < 0.1 THEN 'too_short' WHEN d > 20 THEN 'too_long' END AS reason
        FROM (SELECT path, CASE WHEN NOT cut THEN n::DOUBLE / rate END AS d FROM wav_files)"""),
    "train_bpe": _with(_merge_rounds(BPE_ROUNDS), "SELECT * FROM merges"),
    "vocabulary": _with(_merge_rounds(BPE_ROUNDS), f"""
        SELECT id::INT AS id, piece, NULL::INT AS rank
        FROM (VALUES (0, '<pad>'), (1, '<unk>'), (2, '<s>'), (3, '</s>'), (4, '<blank>')) t(id, piece)
        UNION ALL SELECT (5 + rank)::INT, piece, rank FROM merges
        UNION ALL SELECT (4 + (SELECT count(*) FROM merges) + row_number() OVER (ORDER BY n DESC, char))::INT, char, NULL
        FROM ranked WHERE covered"""),
    "spread_seconds": "SELECT count(*) AS n, round(sum(n_chars / 15), 3) AS seconds, true AS near FROM documents",
    "transcribe": _with(UTT, "SELECT path, replace(string_split(path, '/')[-1], '.wav', '') AS transcription FROM files"),
    "transcribe_directory": _with(WAV_FILES, "SELECT path, lpad(vec_id::VARCHAR, 8, '0') AS transcription FROM listed"),
    "evaluate_manifest": _with(SPOKEN + "," + _alignment("spoken"), _RATES, recursive=True),
    "prepare_local_corpus": _with(EXPLAINED, f"""SELECT reason AS item, count(*) AS n FROM explained WHERE reason IS NOT NULL GROUP BY 1
        UNION ALL SELECT split, count(*) FROM {_split('valid', 0.1)} GROUP BY 1"""),
    "prepare_local_manifest": _with(EXPLAINED, f"""SELECT audio_filepath, text, duration, split
        FROM {_split('valid', 0.1)}"""),
    "prepare_dataset_no_audio": _with(WAVE, """SELECT split || ':no_audio_col' AS item, count(*) AS n FROM wave GROUP BY split"""),
    "prepare_dataset_plain_audio": _with(WAVE, """SELECT split || CASE WHEN has_audio THEN ':audio_not_dict' ELSE ':no_audio_col' END AS item,
        count(*) AS n FROM wave GROUP BY 1"""),
    "prepare_dataset_no_rate": _with(WAVE, f"""SELECT split || ':' || coalesce(
            CASE WHEN NOT has_audio THEN 'no_audio_col' WHEN samples IS NULL THEN 'no_array' WHEN text = '' THEN 'no_text'
            WHEN {_strip('text')} = '' THEN 'empty_text' END, round(len(samples) / 16000.0::DOUBLE, 3)::VARCHAR) AS item,
        count(*) AS n FROM wave GROUP BY 1"""),
    "prepare_dataset_corpus": _with(WAVE_VALID, f"""SELECT '/out/audio/' || split || '/' || split || '_' || lpad(row_idx::VARCHAR, 8, '0') || '.wav' AS audio_filepath,
        {_strip('text')} || ' <hi-IN>' AS text, round(n_out / 16000.0::DOUBLE, 3) AS duration, split FROM valid_wave"""),
    "prepare_dataset_embedded": _with(EMBEDDED, f"""SELECT '/out/audio/' || split || '/' || split || '_' || lpad(row_idx::VARCHAR, 8, '0') || '.wav' AS audio_filepath,
        {_strip('text')} AS text, round(ceil(n * 16000::DOUBLE / hz) / 16000.0::DOUBLE, 3) AS duration, split
        FROM embedded WHERE reason IS NULL AND samples = 'wav'
        UNION ALL
        SELECT NULL, coalesce(reason, 'error'), count(*)::DOUBLE, split FROM embedded
        WHERE reason IS NOT NULL OR samples = 'flac' GROUP BY 2, 4"""),
    "stream_manifest": _with(WAVE_VALID, f"""SELECT row_idx, '/out/audio/' || s || '/' || lpad(row_idx::VARCHAR, 8, '0') || '.wav' AS audio_filepath,
        {_strip('text')} AS text, round(n_out / 16000.0::DOUBLE, 3) AS duration, s AS split
        FROM (SELECT *, {HASH_SPLIT} AS s FROM valid_wave)"""),
}
