"""Repeated spans by compaction of a de Bruijn graph of words.

Edges are runs of ``span`` words, nodes their first and last ``span - 1`` words. Only edges that can
occur twice enter the graph: a repeated run has a repeated minimizer, the smallest hash among its
shorter runs, and only minimizers are counted over all documents. Repeated edges carry the coordinate
of their first occurrence. Paths without branches are compacted along these coordinates, and every
later occurrence is traced along a path and its coordinates into maximal spans, which are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from speechloom.llm.common import WordHasher, mixed, settled, slices, utf8, windows, word_spans

SPAN = 20
SEED_WORDS = 10
SLICE_BYTES = 1 << 20


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Smallest or largest of each ``width`` consecutive values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = best(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return best(values[:-rest], values[rest:]) if rest else values


class _Words:
    """Word hashes of a slice, which runs of ``span`` words stay in one text, and their minimizers."""

    def __init__(self, texts: pa.Array, span: int, seed_words: int):
        self.data, offsets = utf8(texts)
        self.first, self.end, self.of = word_spans(self.data, offsets)
        self.hashes = WordHasher(6)(self.data, self.first, self.end)
        n = max(len(self.hashes) - span + 1, 0)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.of))
        self.inside = self.text[:n] == self.text[span - 1:] if n else np.empty(0, bool)
        self.seeds = windows(self.hashes, seed_words, 60) if n else np.empty(0, np.uint64)
        self.width = span - seed_words + 1
        self.low = _sliding(self.seeds, self.width, np.minimum) if n else self.seeds

    def minimizers(self) -> tuple[np.ndarray, np.ndarray]:
        """Text number and hash of every place that is the minimizer of some run; ties all count."""
        if not len(self.low):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        low = np.where(self.inside, self.low, 0)
        pad = np.zeros(self.width - 1, np.uint64)
        high = _sliding(np.concatenate([pad, low, pad]), self.width, np.maximum)
        places = np.flatnonzero((high == self.seeds) & (self.seeds > 0))
        return self.text[places], self.seeds[places]

    def keys(self) -> np.ndarray:
        place = np.arange(len(self.hashes), dtype=np.uint64) - np.repeat(self.of[:-1], np.diff(self.of)).astype(np.uint64)
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(self.hashes + (place + np.uint64(1)) * np.uint64(k)))])
                for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
        n = np.diff(self.of).astype(np.uint64)
        return np.stack([mixed(s[self.of[1:]] - s[self.of[:-1]] + n) for s in sums], axis=1).astype(np.int64)


    def variants(self, lists: pa.Array) -> np.ndarray:
        """Of each text, its number among the keys of all texts of its doc_id; null where there is one text."""
        out = np.zeros(len(lists), np.int32)
        for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)):
            out[i] = sorted(lists[int(i)].as_py()).index(int(self.keys()[i, 0]))
        return out


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))


def _whole(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, n_words, sha`` of every row, sha of all words joined by one space."""

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            w = _Words(batch.column("text"), SPAN, SEED_WORDS)
            keys = w.keys()
            raw, sha = w.data.tobytes(), []
            for i in range(batch.num_rows):
                own = slice(w.of[i], w.of[i + 1])
                sha.append(hashlib.sha256(b" ".join(
                    raw[a:b] for a, b in zip(w.first[own].tolist(), w.end[own].tolist()))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.diff(w.of)),
                 pa.array(sha, pa.string())], ["doc_id", "k1", "k2", "n_words", "sha"])

    return _slim(docs).mapInArrow(run, "doc_id bigint, k1 bigint, k2 bigint, n_words bigint, sha string")


def _minimizers(docs: DataFrame, span: int, seed_words: int) -> DataFrame:
    """``seed, doc_id`` for every minimizer occurrence."""

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            text, seeds = _Words(batch.column("text"), span, seed_words).minimizers()
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seeds.astype(np.int64)), pa.array(ids[text], pa.int64())], ["seed", "doc_id"])

    return _slim(docs).filter("doc_id is not null").mapInArrow(run, "seed bigint, doc_id bigint")


EDGES = "doc_id bigint, variant int, start int, own_first int, u bigint, v bigint"


def _edges(texts: DataFrame, span: int, seed_words: int) -> DataFrame:
    """``doc_id, variant, start, own_first, u, v`` of the runs whose minimizer is repeated.

    u and v are the nodes; own_first is where the run came before in the same text, else null.
    """

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            w = _Words(batch.column("text"), span, seed_words)
            if not len(w.low):
                continue
            nodes = windows(w.hashes, span - 1, 61)
            numbers, out = w.variants(batch.column("texts")), []
            for i, repeated in enumerate(batch.column("seeds")):
                a, b = int(w.of[i]), int(w.of[i + 1]) - span + 1
                if b > a:
                    hits = np.flatnonzero(np.isin(w.low[a:b].astype(np.int64), repeated.values.to_numpy()))
                    u, v = nodes[a + hits], nodes[a + hits + 1]
                    _, at, of = np.unique(mixed(u + v * np.uint64(0xD6E8FEB86659FD93)), return_index=True, return_inverse=True)
                    first = hits[at[of]]
                    out.append((np.full(len(hits), batch.column("doc_id")[i].as_py(), np.int64),
                                np.full(len(hits), numbers[i]), hits, first, u, v))
            if out:
                doc_id, variant, start, first, u, v = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id), pa.array(variant.astype(np.int32)), pa.array(start.astype(np.int32)),
                     pa.array(first.astype(np.int32), mask=first == start), pa.array(u.astype(np.int64)),
                     pa.array(v.astype(np.int64))], ["doc_id", "variant", "start", "own_first", "u", "v"])

    return texts.mapInArrow(run, EDGES)


def compacted(edges: DataFrame) -> DataFrame:
    """Repeated edges ``u, v, first_doc, first_start, path_start``: paths run along first coordinates.

    An edge continues the path of the edge before it if their common node has one way in and one way
    out. A path stays within its first document, so no group is larger than a document.
    """
    repeated = settled(
        edges.groupBy("u", "v").agg(
            F.min("doc_id").alias("first_doc"), F.min_by("start", "doc_id").alias("first_start"), F.count("*").alias("n"))
        .filter("n > 1").drop("n"), "repeated")
    ways = repeated.select(F.col("u").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        repeated.select(F.col("v").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    plain = settled(
        ways.groupBy("node").agg(F.sum("o").alias("o"), F.sum("i").alias("i")).filter("o = 1 and i = 1")
        .select("node", F.lit(True).alias("plain")), "plain")
    along = Window.partitionBy("first_doc").orderBy("first_start")
    joined = repeated.join(plain, repeated.u == plain.node, "left")
    goes_on = F.coalesce("plain", F.lit(False)) & (F.lag("first_start").over(along) == F.col("first_start") - 1)
    heads = joined.withColumn("head", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("first_start")))
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    paths = heads.select(
        "u", "v", "first_doc", "first_start", F.last("head", ignorenulls=True).over(upto).alias("path_start"))
    return settled(paths, "paths", (repeated, plain))


def repeated_spans(edges: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, variant, start, length, source_doc, source_start``: maximal later occurrences, in words.

    Every span equals the words at its source coordinate, which come earlier.
    """
    paths = compacted(edges.filter("own_first is null"))
    again = F.col("own_first").isNotNull()
    later = edges.join(paths, ["u", "v"], "left").filter(again | (F.col("doc_id") != F.col("first_doc"))).select(
        "doc_id", "variant", "start",
        F.when(again, F.col("doc_id")).otherwise(F.col("first_doc")).alias("first_doc"),
        F.when(again, F.col("own_first")).otherwise(F.col("first_start")).alias("first_start"),
        F.when(again, -1).otherwise(F.col("path_start")).alias("path_start"))
    # along a document, a span goes on while its source does: same document, same path, next word
    along = Window.partitionBy("doc_id", "variant").orderBy("start")
    goes_on = F.lit(True)
    for name, step in (("start", 1), ("first_start", 1), ("first_doc", 0), ("path_start", 0)):
        goes_on = goes_on & (F.col(name) == F.lag(name).over(along) + step)
    island = F.sum("head").over(along.rowsBetween(Window.unboundedPreceding, 0))
    traced = later.withColumn(
        "head", F.when(goes_on, 0).otherwise(1)).withColumn("island", island)
    return traced.groupBy("doc_id", "variant", "island").agg(
        F.min("start").alias("start"), (F.count("*") + span - 1).alias("length"),
        F.min("first_doc").alias("source_doc"), F.min("first_start").alias("source_start")).drop("island")


def _kept(texts: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, n_removed, kept_sha, kept_text`` of texts with ``spans`` of words to remove.

    ``variant`` numbers the text that the spans are in, should several texts have the doc_id.
    """

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            w = _Words(batch.column("text"), SPAN, SEED_WORDS)
            keys, removed, sha, text = w.keys(), [], [], []
            raw = w.data.tobytes()
            own = np.flatnonzero(w.variants(batch.column("texts")) == batch.column("variant").to_numpy())
            for i in map(int, own):
                spans = batch.column("spans")[i].as_py()
                a, b = int(w.of[i]), int(w.of[i + 1])
                gone = np.zeros(b - a + 1, np.int64)
                for s in spans:
                    gone[s["start"]] += 1
                    gone[s["start"] + s["length"]] -= 1
                keep = np.flatnonzero(np.cumsum(gone)[:-1] == 0) + a
                left = b" ".join(raw[x:y] for x, y in zip(w.first[keep].tolist(), w.end[keep].tolist()))
                removed.append(b - a - len(keep))
                sha.append(hashlib.sha256(left).hexdigest())
                text.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(own)), *map(pa.array, keys[own].T), pa.array(removed, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(text, pa.string())],
                ["doc_id", "k1", "k2", "n_removed", "kept_sha", "kept_text"])

    return texts.mapInArrow(
        run, "doc_id bigint, k1 bigint, k2 bigint, n_removed bigint, kept_sha string, kept_text string")


def remove_repeats(docs: DataFrame, *, span: int = SPAN, seed_words: int = SEED_WORDS,
                   keep_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row, and ``kept_text`` of changed ones on request.

    A word goes if a run of ``span`` words over it also starts earlier: in a smaller doc_id, or before
    in the same text. Rows with one doc_id do not count as earlier than one another. Rows without
    doc_id neither lose words nor count as earlier. Null texts have no words; an empty table gives no
    rows; other columns are not looked at.
    """
    whole = settled(_whole(docs), "words")
    # a later copy of a whole document loses all its words; only first copies enter the graph
    first = settled(
        whole.filter(f"doc_id is not null and n_words >= {span}").groupBy("k1", "k2").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    marked = settled(
        whole.join(first, ["k1", "k2"], "left").select(
            "doc_id", "k1", "k2", "n_words", "sha", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy")),
        "marked", (whole, first))
    seeds = _minimizers(docs, span, seed_words)
    repeated = settled(
        seeds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed"), "seeds")
    # the texts of one doc_id, almost always one; documents that are copies as a whole stay out
    named = marked.filter("doc_id is not null").groupBy("doc_id").agg(
        F.collect_set("k1").alias("texts"), F.min("copy").alias("copies")).filter("not copies").drop("copies")
    hits = seeds.join(repeated, "seed", "left_semi").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds"))
    hits = settled(hits.join(named, "doc_id").withColumn("texts", F.when(F.size("texts") > 1, F.col("texts"))), "hits",
                   (repeated,))
    texts = settled(_slim(docs).join(hits, "doc_id"), "texts", (hits,))
    # worked out twice from the texts, which takes less than keeping them
    edges = _edges(texts, span, seed_words)
    spans = settled(repeated_spans(edges, span).groupBy("doc_id", "variant").agg(
        F.collect_list(F.struct("start", "length")).alias("spans")), "spans")
    changed = _kept(texts.drop("seeds").join(spans, "doc_id")).dropDuplicates(["doc_id", "k1", "k2"])
    nothing = hashlib.sha256(b"").hexdigest()
    out = marked.join(changed, ["doc_id", "k1", "k2"], "left")
    return out.select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), nothing).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        *([F.when(F.col("copy"), "").otherwise(F.col("kept_text")).alias("kept_text")] if keep_text else []),
    )
