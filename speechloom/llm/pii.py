"""Personal data: candidate spans judged by gradient-boosted trees.

Strict generators give the base spans, which always stay. Loose generators propose more, overlapping
spans of the same kinds. Boosted trees over format and context score these; per kind, a threshold
set on all held-out candidates selects what is added. The trees learn from base spans and from
candidates that fail a kind's check, in a bounded sample of different candidates of each kind (``SAMPLE``).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.llm.common import let_go, settled, slices, utf8

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
PRECISION = 0.98
SCORES = 1 << 14  # a power of two, so that the lower end of a bin of scores is exact
BINS = 24
DEPTH = 3
ROUNDS = 40
RATE = 0.3

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# a run of digits that can't begin an address can't do so from its middle either
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOOSE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64} ?(?:[\[(]at[\])]|@) ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]{1,63}){0,8}", re.I),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,5}(?: ?[.,] ?[0-9]{1,5}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){9,21}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+|00)?[0-9(][0-9 ().\-/]{5,24}[0-9](?![0-9])"),
}
AT = re.compile(r"[\[(]at[\])]|@", re.I)

# Words before a span that speak for a kind.
CUES = {
    "email": ("mail", "contact", "correo", "courriel", "@"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "carte", "karte", "tarjeta", "payment", "iban"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "rufnummer", "móvil"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strict generators, in order of start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        # long runs are dropped before their digits are looked at
        if m.end() - m.start() <= 37 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans of the loose generators; spans of different kinds may overlap."""
    out = []
    for m in AT.finditer(text):
        lo = max(0, m.start() - 66)
        out += [(x.start() + lo, 0, x.end() + lo) for x in LOOSE["email"].finditer(text[lo:m.end() + 200])
                if x.start() + lo < m.end() <= x.end() + lo]
    for k in (1, 2, 3):
        out += [(m.start(), k, m.end()) for m in LOOSE[KINDS[k]].finditer(text)]
    return sorted(set(out))


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in ".,;:!?" else 4


def features(text: str, span: tuple[int, int, int], near: int) -> list[int]:
    """Format of the span and what stands around it, as small whole numbers below ``BINS``."""
    start, kind, end = span
    s = text[start:end]
    groups = re.findall(r"[0-9]+", s)
    lengths = [len(g) for g in groups] or [0]
    before, after = text[max(0, start - 24):start].lower(), text[end:end + 12].lower()
    d = "".join(groups)
    row = [
        kind, len(d), len(groups), max(lengths), min(lengths), len(set(re.findall(r"[^0-9A-Za-z]", s))),
        luhn(d) if d else 0, bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups), s[0] == "+",
        s[:2] == "00", "(" in s and ")" in s, "@" in s, "[at]" in s.lower() or "(at)" in s.lower(),
        len(re.findall(r"\.[A-Za-z]", s)), s.count("."), s.count("-"), s.count(" "), s.count(","),
        sum(c.isalpha() for c in s), _side(text[start - 1:start] if start else ""), _side(text[end:end + 1]),
        any(c in before for c in CUES[KINDS[kind]]), sum(c.isdigit() for c in before),
        sum(c.isdigit() for c in after), near,
    ]
    return [min(int(v), BINS - 1) for v in row]


N_FEATURES = 25


def proposals(text: str) -> tuple[list, list, np.ndarray, list[int]]:
    """Base spans, candidates, their features, and labels: 1 base, 0 fails a check, -1 not known."""
    base, found = base_spans(text), candidates(text)
    known = set(base)
    starts = np.array([c[0] for c in found])
    rows, labels = [], []
    for c in found:
        near = int(np.searchsorted(starts, c[2] + 40) - np.searchsorted(starts, c[0] - 40)) - 1
        rows.append(features(text, c, near))
        labels.append(1 if c in known else 0 if _fails(text[c[0]:c[2]], c[1]) else -1)
    return base, found, np.array(rows, np.int8).reshape(-1, N_FEATURES), labels


def _fails(s: str, kind: int) -> bool:
    d = _digits(s)
    if kind == 0:
        return "." not in s and "dot" not in s.lower()
    if kind == 1:
        return any(int(p) > 255 for p in re.findall(r"[0-9]+", s))
    if kind == 2:
        return not (12 <= len(d) <= 19 and luhn(d))
    return not 9 <= len(d) <= 15 or not re.search(r"[ ().+-]", s)


class Trees:
    """Gradient boosting with logistic loss over complete trees of fixed depth."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        score = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p) + 1e-9
            at = np.zeros(len(y), np.int64)
            feature, cut = np.zeros((1 << DEPTH) - 1, int), np.full((1 << DEPTH) - 1, BINS)
            for level in range(DEPTH):
                n = 1 << level
                gains = np.full((x.shape[1], n, BINS), -1.0)
                for f in range(x.shape[1]):
                    key = at * BINS + x[:, f]
                    gl = np.bincount(key, g, n * BINS).reshape(n, BINS).cumsum(1)
                    hl = np.bincount(key, h, n * BINS).reshape(n, BINS).cumsum(1)
                    gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                    gains[f] = gl**2 / (hl + 1) + gr**2 / (hr + 1)
                best = gains.transpose(1, 0, 2).reshape(n, -1).argmax(axis=1)
                own = slice(n - 1, 2 * n - 1)
                feature[own], cut[own] = best // BINS, best % BINS
                at = 2 * at + (x[np.arange(len(y)), feature[n - 1 + at]] > cut[n - 1 + at])
            leaf = np.bincount(at, g, 1 << DEPTH) / (np.bincount(at, h, 1 << DEPTH) + 1) * RATE
            self.splits.append((feature, cut, leaf))
            score += leaf[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for feature, cut, leaf in self.splits:
            at = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                node = (1 << level) - 1 + at
                at = 2 * at + (x[np.arange(len(x)), feature[node]] > cut[node])
            total += leaf[at]
        return 1 / (1 + np.exp(-total))


def thresholds(counts: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Per kind, the lowest score from which held-out candidates are right often enough; 2 where there is none.

    ``counts`` are kind, bin of scores, right and all candidates.
    """
    least = np.full(len(KINDS), 2.0)
    for k in range(len(KINDS)):
        right, total = np.zeros(SCORES + 1, np.int64), np.zeros(SCORES + 1, np.int64)
        for kind, place, r, n in counts:
            if kind == k:
                right[place] += r
                total[place] += n
        right, total = right[::-1].cumsum()[::-1], total[::-1].cumsum()[::-1]
        own = np.append(total[:-1] > total[1:], total[-1] > 0)
        good = np.flatnonzero(own & (right >= PRECISION * total))
        if len(good):
            least[k] = max(0.5, good[0] / SCORES)
    return least


class Model:
    """Trees, if there was something to learn, and per kind the lowest score of what is added."""

    def __init__(self, trees: Trees | None, least: np.ndarray):
        self.trees, self.least = trees, least

    def added(self, base: list, found: list, x: np.ndarray) -> list[tuple[int, int, int]]:
        """Candidates over their threshold, best first, that touch no span taken before."""
        if self.trees is None or not len(found):
            return []
        score = self.trees.score(x.astype(np.int64))
        taken, out = [(a, b) for a, _, b in base], []
        for i in np.argsort(-score, kind="stable"):
            a, kind, b = found[i]
            if score[i] >= self.least[kind] and all(b <= c or a >= d for c, d in taken):
                taken.append((a, b))
                out.append(found[i])
        return out


_MARKS = np.zeros(256, bool)
_MARKS[[*range(48, 58), *b"@[("]] = True


def _worth(texts: pa.Array) -> np.ndarray:
    """Which texts hold a digit or a sign that any generator needs."""
    data, offsets = utf8(texts)
    seen = np.concatenate([[0], np.cumsum(_MARKS[data])])
    return seen[offsets[1:]] > seen[offsets[:-1]]


def fit(docs: DataFrame) -> Model:
    """Trees from a sample of labelled candidates of all texts, thresholds from all held-out ones.

    Of each kind an equal part of ``SAMPLE``, those with the smallest hashes, comes to the driver;
    candidates that are equal with what stands around them count once there. A quarter by hash is held out.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            keys, kinds, rows, labels = [], [], [], []
            for i in np.flatnonzero(_worth(texts)):
                text = texts[int(i)].as_py()
                _, found, x, y = proposals(text)
                for c, row, label in zip(found, x, y):
                    if label >= 0:
                        about = f"{c}{text[max(0, c[0] - 20):c[2] + 20]}"
                        kinds.append(c[1])
                        keys.append(hashlib.sha256(about.encode()).hexdigest()[:16])
                        rows.append(row.tobytes())
                        labels.append(label)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([int(k, 16) % 4 == 0 for k in keys], pa.bool_()),
                 pa.array(kinds, pa.int32()), pa.array(rows, pa.binary()), pa.array(labels, pa.int32())],
                ["key", "held", "kind", "x", "y"])

    known = settled(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        run, "key string, held boolean, kind int, x binary, y int"), "candidates")
    rows = []
    for k in range(len(KINDS)):
        own = known.filter(~F.col("held") & (F.col("kind") == k))
        # minima on the way: copies of one text may be a third of all rows
        distinct = own.groupBy("key").agg(F.min(F.struct("x", "y")).alias("row"))
        rows += distinct.orderBy("key").limit(SAMPLE // len(KINDS)).select("row.*").collect()
    x = _matrix([bytes(r["x"]) for r in rows])
    y = np.array([r["y"] for r in rows], np.int64)
    trees, least = None, np.full(len(KINDS), 2.0)
    if len(set(y.tolist())) == 2:
        trees = Trees(x.astype(np.int64), y.astype(float))
        least = thresholds(_score_counts(known.filter("held"), trees))
    let_go(docs.sparkSession, (known,))
    return Model(trees, least)


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.int8).reshape(-1, N_FEATURES)


def _score_counts(held: DataFrame, trees: Trees) -> list[tuple[int, int, int, int]]:
    """Kind, bin of scores, right and all candidates; at most ``SCORES`` + 1 rows per kind."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = trees.score(_matrix(batch.column("x").to_pylist()).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("kind"), pa.array((score * SCORES).astype(np.int32)), batch.column("y")],
                    ["kind", "place", "y"])

    scored = held.select("kind", "x", "y").mapInArrow(run, "kind int, place int, y int")
    counts = scored.groupBy("kind", "place").agg(F.sum("y").alias("right"), F.count("*").alias("total")).collect()
    return [(r["kind"], r["place"], r["right"], r["total"]) for r in counts]


def _spans(model: Model, text: str) -> tuple[list, list]:
    base, found, x, _ = proposals(text)
    return base, sorted([*base, *model.added(base, found, x)])


def _told(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for every row.

    The counts are of base spans. A null text counts as empty and has no spans; an empty table gives
    no rows; repeated rows and rows without doc_id are judged like others; texts of any length are
    read whole; other columns are not looked at.
    """
    model = model or fit(docs)
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            n = batch.num_rows
            counts, digest, told, added = np.zeros((4, n), np.int64), [nothing] * n, [""] * n, np.zeros(n, np.int64)
            for i in map(int, np.flatnonzero(_worth(texts))):
                base, spans = _spans(model, texts[i].as_py())
                for _, k, _ in base:
                    counts[k, i] += 1
                digest[i] = hashlib.sha256(_told(base).encode()).hexdigest()
                told[i], added[i] = _told(spans), len(spans) - len(base)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, counts), pa.array(digest, pa.string()),
                 pa.array(told, pa.string()), pa.array(added)],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
        "spans string, n_added bigint")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at, open_to = [], 0, -1
    for start, kind, end in spans:
        if start >= open_to:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = open_to = max(open_to, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows with all their columns; personal data in ``text`` is replaced, and ``n_chars``, where
    there is one, follows the changed texts."""
    model = model or fit(docs)
    count = "n_chars" if "n_chars" in docs.columns else None

    def run(batches):
        for batch in slices(batches, "text"):
            texts, new = batch.column("text"), {}
            for i in map(int, np.flatnonzero(_worth(texts))):
                text = texts[i].as_py()
                _, spans = _spans(model, text)
                if spans:
                    new[i] = redacted(text, spans)
            if new:
                names = batch.schema.names
                columns = list(batch.columns)
                columns[names.index("text")] = pa.array(
                    [new.get(i, v) for i, v in enumerate(texts.to_pylist())], batch.schema.field("text").type)
                if count:
                    j = names.index(count)
                    columns[j] = pa.array(
                        [len(new[i]) if i in new else v for i, v in enumerate(batch.column(j).to_pylist())],
                        batch.schema.field(j).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)
