"""Language identification by error-correcting output codes.

Every language gets a codeword. For each bit a naive Bayes classifier over hashed character n-grams
says which side a text is on; decoding weighs each bit by how well it did on the learning rows and
takes the codeword with the smallest loss. Counts and bit weights come from all learning rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.llm.common import slices, utf8

BUCKETS = 4096
SLICE_BYTES = 1 << 20
SLICE_ROWS = 128
EXHAUSTIVE = 6
GAP = 0.15
UNKNOWN = "und"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes (lower case, all ASCII but letters as space) and bucket values by place in the n-gram."""
    kind = np.arange(256, dtype=np.uint8)
    kind[:128] = 0x20
    kind[97:123] = np.arange(97, 123)
    kind[65:91] = np.arange(97, 123)
    return kind, np.random.default_rng(9).integers(0, BUCKETS, (5, 256), dtype=np.int32)


def profiles(texts: pa.Array) -> np.ndarray:
    """Counts of hashed 2-grams and 3-grams per text; n-grams of separators alone don't count."""
    kind, values = _tables()
    data, offsets = utf8(texts)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros((n, BUCKETS))
    d = kind[data]
    one, two = np.empty_like(d), np.empty_like(d)
    one[1:], two[2:] = d[:-1], d[:-2]
    begins = offsets[:-1][offsets[1:] > offsets[:-1]]
    one[begins] = 0x20
    two[begins] = 0x20
    two[begins[begins + 1 < len(d)] + 1] = 0x20
    row = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offsets))
    real = (d != 0x20) | (one != 0x20)
    pairs = row + (values[0][d] ^ values[1][one])
    out = np.bincount(pairs[real], minlength=n * BUCKETS)
    real |= two != 0x20
    triples = row + (values[2][d] ^ values[3][one] ^ values[4][two])
    out += np.bincount(triples[real], minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS).astype(np.float64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k rows of +1 and -1: every two-sided split for few languages, else balanced random ones."""
    if k < 2:
        return np.ones((k, 0))
    if k <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (k - 1))
        bits = (splits[None, :] >> np.arange(k)[:, None]) & 1
        return np.where(bits == 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    length = 15 * int(np.ceil(np.log2(k)))
    side = np.where(np.arange(k) % 2 == 0, 1.0, -1.0)
    return np.stack([rng.permutation(side) for _ in range(length)], axis=1)


class Model:
    """Languages, codewords, weights of the bit classifiers and of the decoding."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        self.bits = np.stack(
            [np.log(share[c > 0].mean(axis=0)) - np.log(share[c < 0].mean(axis=0)) for c in self.code.T], axis=1
        ) if self.code.shape[1] else np.zeros((BUCKETS, 0))
        self.scale = np.ones(self.code.shape[1])
        self.weight = np.ones(self.code.shape)

    def margins(self, found: np.ndarray) -> np.ndarray:
        return found @ self.bits / np.maximum(found.sum(axis=1, keepdims=True), 1)

    def decode(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity for each row of counts."""
        if self.code.shape[1] == 0:
            n = len(found)
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
        m = np.clip(self.margins(found) / self.scale, -4, 4)
        loss = np.einsum("kb,nkb->nk", self.weight, np.exp(-self.code[None] * m[:, None, :]))
        best = loss.argmin(axis=1)
        rest = loss.copy()
        rest[np.arange(len(m)), best] = np.inf
        low = loss[np.arange(len(m)), best]
        p = np.exp(-4 * (loss - low[:, None]))
        return best, 1 / p.sum(axis=1), rest.min(axis=1) - low < GAP


def _pieces(batches):
    """Slices of bounded bytes and rows."""
    for batch in slices(batches, "text", SLICE_BYTES):
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """Learn from text and lang of all rows that have a doc_id, a lang and are not held out."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in _pieces(batches):
            found = profiles(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in set(langs):
                total[lang] = total.get(lang, 0) + found[langs == lang].sum(axis=0)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            # a language whose texts are all empty is learned, too
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1)), pa.array([*at, 0], pa.int32()),
                 pa.array([*n[at].astype(np.int64), 0], pa.int64())], ["lang", "bucket", "n"])

    sums = labelled.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n"))
    rows = sums.collect()  # one per language and bucket at most
    langs = sorted({r[0] for r in rows})
    counts = np.zeros((len(langs), BUCKETS))
    for lang, bucket, n in rows:
        counts[langs.index(lang), bucket] = n
    model = Model(langs, counts)
    n_bits = model.code.shape[1]
    if not n_bits:
        return model

    def tell(batches):
        """Per language: rows, and per bit the right ones and the sum of the margins' sizes in millionths."""
        seen = np.zeros((len(langs), 1 + 2 * n_bits))
        for batch in _pieces(batches):
            number = np.array([langs.index(x) for x in batch.column("lang").to_pylist()])
            found = profiles(batch.column("text"))
            some = found.sum(axis=1) > 0
            m, number = model.margins(found[some]), number[some]
            right = m * model.code[number] > 0
            np.add.at(seen, number, np.concatenate(
                [np.ones((len(m), 1)), right, np.round(np.abs(m) * 1e6)], axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(langs)), pa.int32()), pa.array(seen.astype(np.int64).tolist(), pa.list_(pa.int64()))],
            ["k", "seen"])

    told = labelled.mapInArrow(tell, "k int, seen array<bigint>").select("k", F.posexplode("seen").alias("i", "n"))
    seen = np.zeros((len(langs), 1 + 2 * n_bits))
    for k, i, n in told.groupBy("k", "i").agg(F.sum("n")).collect():
        seen[k, i] = n
    rows_of = np.maximum(seen[:, :1], 1)
    model.scale = np.maximum((seen[:, 1 + n_bits:] / rows_of).mean(axis=0) / 1e6, 1e-9)
    right = np.maximum(seen[:, 1:1 + n_bits] / rows_of, 1e-3)
    model.weight = right / right.sum(axis=1, keepdims=True)
    return model


def _judged(model: Model, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    found = profiles(texts)
    letter = np.array([has_letter(t) for t in texts.to_pylist()], bool)
    if not model.langs:
        letter[:] = False
        return [UNKNOWN] * len(letter), np.zeros(len(letter)), np.zeros(len(letter), bool)
    best, score, unsure = model.decode(found)
    pred = [model.langs[b] if a else UNKNOWN for a, b in zip(letter, best)]
    return pred, np.where(letter, score, 0.0), letter & unsure


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row.

    Null texts and texts without a letter are ``und`` with score 0; so is everything when no row can
    be learned from. A row without doc_id is judged, not learned from and not held out. Repeated rows
    are judged alike; other columns are not looked at; an empty table gives no rows.
    """
    model = model or fit(docs)

    def run(batches):
        for batch in _pieces(batches):
            pred, score, unsure = _judged(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(
        F.col("doc_id").cast("bigint"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_known(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows, with all their columns, whose text has a language; ``und`` rows go."""
    model = model or fit(docs)

    def run(batches):
        for batch in _pieces(batches):
            pred, _, _ = _judged(model, batch.column("text"))
            kept = batch.filter(pa.array([p != UNKNOWN for p in pred]))
            if kept.num_rows:
                yield kept

    return docs.mapInArrow(run, docs.schema)
