"""Near-duplicate documents by minima of universal hashes, banding and full verification.

Texts with the same words are one class. Bands of each class's signature go to buckets, where every
member is compared with the first one: links are confirmed on full shingle sets and give components.
Members of buckets that still hold several components are then joined on their rarest shingles. Sets
that are similar enough share one of these, so no link between components is lost, and sets that only
look alike in a band, by the thousand perhaps, do not meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from speechloom.llm.common import WordHasher, mixed, slices, utf8, windows, word_spans
from speechloom.llm.connected import components
from speechloom.workspace import written

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 24, 4
SLICE_BYTES = 1 << 20
SLACK = 5.0
LARGE_GROUP = 32  # sets that have a shingle among their rarest


def shingles(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text: its number of words, sorted distinct shingle hashes, and a hash of all words in order."""
    hasher = WordHasher(4, lower=True)
    data, offsets = utf8(texts)
    first, end, of = word_spans(data, offsets)
    hashes = hasher(data, first, end)
    runs = windows(hashes, width, 40)
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(of[:-1], np.diff(of)).astype(np.uint64)
    whole = np.stack([
        np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + (place + np.uint64(1)) * np.uint64(k)))])
        for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
    ])
    for i in range(len(offsets) - 1):
        a, b = int(of[i]), int(of[i + 1])
        n = b - a
        if n >= width:
            own = np.unique(runs[a:b - width + 1])
        elif n:
            own = windows(hashes[a:b], n, 40 + n)
        else:
            own = np.empty(0, np.uint64)
        yield n, own, whole[:, b] - whole[:, a]


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(44)
    n = BANDS * ROWS
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(
        0, 1 << 63, n, dtype=np.uint64)


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, k1, k2, n_shingles, signature``: equal k1, k2 mean the same words."""

    def run(batches):
        factor, shift = _factors()
        for batch in slices(batches, "text", SLICE_BYTES):
            sets, keys, sizes = [], [], []
            for n, own, key in shingles(batch.column("text"), width):
                sets.append(own)
                keys.append(mixed(key + np.uint64(n)))
                sizes.append(len(own))
            sizes = np.array(sizes, np.int64)
            some = np.flatnonzero(sizes)
            out = np.zeros((len(sizes), len(factor)), ">u4")
            if len(some):
                flat = np.concatenate([sets[i] for i in some])
                begin = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                for j in range(len(factor)):
                    out[some, j] = np.minimum.reduceat(flat * factor[j] + shift[j], begin) >> np.uint64(32)
            keys = np.array(keys, np.uint64).reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sizes),
                 pa.array([r.tobytes() for r in out], pa.binary())],
                ["doc_id", "k1", "k2", "n_shingles", "signature"])

    return _slim(docs).mapInArrow(
        run, "doc_id bigint, k1 bigint, k2 bigint, n_shingles bigint, signature binary")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = [own.astype(np.int64) for _, own, _ in shingles(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return _slim(docs).mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def _alike(least: int):
    """Keeps pairs whose signatures agree in at least ``least`` places."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1)
                        for c in ("sa", "sb"))
                yield batch.filter(pa.array((x == y).sum(axis=1) >= least)).select(["a", "b"])

    return run


def rare_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different ``component`` that may have ``percent`` of common shingles; none is missed.

    In each set shingles are put in order, rarest first. Of two similar sets the smaller one's first
    shingles (``index``) meet the larger one's (``probe``), and what follows the first meeting in both
    must suffice for the similarity. Shingles of one set alone only push the others back. Whether two sets
    suffice depends on their sizes and the places of the shingle in them alone. So where ``LARGE_GROUP`` or
    more sets share a shingle, different sizes and places meet first, then the components that have them,
    and sets only where both suffice and the components differ.
    """
    rows = sets.select("doc_id", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    common = written(rows.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1"), "common")
    by = Window.partitionBy("doc_id")
    ordered = rows.join(common, "s").withColumn("at", F.row_number().over(by.orderBy("df", "s")) - 1).withColumn(
        "at", F.col("at") + F.col("n") - F.count("*").over(by))
    # ceilings: percent / 100 of n, and 2 percent / (100 + percent) of n
    probe = written(
        ordered.filter(f"at < n - (n * {percent} + 99) div 100 + 1").select("s", "doc_id", "component", "n", "at"),
        "probe")
    index = f"at < n - (n * {2 * percent} + {99 + percent}) div {100 + percent} + 1"
    several = written(
        probe.groupBy("s").agg(F.count("*").alias("members"), F.min("component").alias("low"),
                               F.max("component").alias("high")).filter("low <> high").select("s", "members"), "several")
    few, many = (probe.join(several.filter(size), "s", "left_semi")
                 for size in (f"members < {LARGE_GROUP}", f"members >= {LARGE_GROUP}"))
    left = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    may = (
        (F.col("x.s") == F.col("y.s"))
        & (F.col("x.n") >= F.col("y.n"))
        & (F.col("y.n") * 100 >= F.col("x.n") * percent)
        & (left * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)
    )
    later = F.struct("x.n", "x.doc_id") > F.struct("y.n", "y.doc_id")
    pair = (F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
    apart = F.col("x.component") != F.col("y.component")
    small = few.alias("x").join(few.filter(index).alias("y"), may & later & apart).select(*pair)

    many = written(many, "many")
    kind, other = ["s", "n", "at"], ["s", "other_n", "other_at"]
    groups = written(many.select(*kind, "component").distinct(), "groups")
    kinds = written(groups.groupBy(*kind).agg(F.min("component").alias("low"), F.max("component").alias("high")), "kinds")
    one = (F.least("x.low", "y.low") == F.greatest("x.high", "y.high"))
    suffice = kinds.alias("x").join(kinds.filter(index).alias("y"), may & ~one).select(
        "x.s", "x.n", "x.at", F.col("y.n").alias("other_n"), F.col("y.at").alias("other_at"))
    others = groups.select("s", F.col("n").alias("other_n"), F.col("at").alias("other_at"), F.col("component").alias("other"))
    meetings = written(
        groups.join(suffice, kind).alias("x").join(others.alias("y"), [*other]).filter("component <> other"), "meetings")
    met = many.select("s", F.col("n").alias("other_n"), F.col("at").alias("other_at"), F.col("component").alias("other"),
                      F.col("doc_id").alias("other_id"))
    large = many.join(meetings, [*kind, "component"]).join(met, [*other, "other"]).filter(
        F.struct("n", "doc_id") > F.struct("other_n", "other_id")).select(
        F.least("doc_id", "other_id").alias("a"), F.greatest("doc_id", "other_id").alias("b"))
    return large.unionByName(small).distinct()


def link_classes(docs: DataFrame, sketch: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Classes ``k1, k2, rep`` of equal words, and ``id, component`` of reps that link with a smaller one."""
    known = sketch.filter("n_shingles > 0 and doc_id is not null")
    classes = written(known.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = written(
        known.join(classes.select("k1", "k2", F.col("rep").alias("doc_id")), ["k1", "k2", "doc_id"], "left_semi")
        .select("doc_id", "signature"), "reps")
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    size = 4 * ROWS
    banded = reps.select("doc_id", "signature", band).select(
        "doc_id",
        F.xxhash64("band", F.expr(f"substring(signature, band * {size} + 1, {size})")).alias("bucket"),
    ).distinct()
    shared = written(
        banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).filter("n > 1"), "buckets")
    members = written(banded.join(shared, "bucket"), "members")
    wanted = members.select("doc_id").distinct()
    sets = written(shingle_sets(_slim(docs).join(wanted, "doc_id", "left_semi"), width), "sets")

    j = percent / 100
    n_hashes = BANDS * ROWS
    alike = _alike(int(n_hashes * j - SLACK * (n_hashes * j * (1 - j)) ** 0.5))

    def confirmed(pairs: DataFrame) -> DataFrame:
        near = pairs.join(reps.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb")), "b").join(
            reps.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa")), "a"
        ).select("a", "b", "sa", "sb").mapInArrow(alike, "a bigint, b bigint")
        near = written(near.distinct(), "near")
        full = near.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("xb")), "b").join(
            sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("xa")), "a")
        both = F.size(F.array_intersect("xa", "xb"))
        ok = full.withColumn("both", both).filter(
            F.col("both") * 100 >= (F.size("xa") + F.size("xb") - F.col("both")) * percent)
        return written(ok.select("a", "b"), "links")

    star = members.filter("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = confirmed(written(star, "pairs"))
    found = components(links)
    state = written(members.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")), "state")
    several = state.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter(
        "x <> y").select("bucket")
    opened = written(state.join(several, "bucket", "left_semi").select("doc_id", "component").distinct(), "open")
    if not opened.isEmpty():
        more = confirmed(written(rare_pairs(sets.join(opened, "doc_id"), percent), "pairs"))
        if not more.isEmpty():
            found = components(links.unionByName(more))
    return classes, found


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT,
                    sketch: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Texts are compared as sets of ``width``-word shingles of their lower-cased (A-Z) words; those
    with fewer words are one shingle, those without words have none and link with nothing. Documents
    link from ``percent`` of common shingles on. Rows with one doc_id are one node. Rows without
    doc_id link with nothing: they have no component_id and are kept. An empty table gives no rows;
    other columns are not looked at.
    """
    return _judged(docs, width, percent, sketch).drop("k1", "k2")


def _judged(docs: DataFrame, width: int, percent: int, sketch: DataFrame | None = None) -> DataFrame:
    sketch = written(sketches(docs, width), "sketch") if sketch is None else sketch
    classes, found = link_classes(docs, sketch, width, percent)
    named = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component"))
    return sketch.select("doc_id", "k1", "k2", "n_shingles").join(named, ["k1", "k2"], "left").select(
        "doc_id", "k1", "k2", "n_shingles",
        F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component"))
        .otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _with_keys(docs: DataFrame) -> DataFrame:
    """The rows with the ``k1, k2`` of their sketches as ``_k1, _k2``."""

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            keys = [mixed(key + np.uint64(n)) for n, _, key in shingles(batch.column("text"), WIDTH)]
            keys = np.array(keys, np.uint64).reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1])], [*batch.schema.names, "_k1", "_k2"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_k1", T.LongType()),
                                              T.StructField("_k2", T.LongType())]))


def drop_near_duplicates(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, of the first document of each group; one row per doc_id and text.

    Rows without doc_id all stay.
    """
    judged = written(_judged(docs, width, percent), "judged")
    again = judged.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    gone = judged.filter("not kept").select("doc_id").distinct()
    if again.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    once = docs.join(gone.unionByName(again).distinct(), "doc_id", "left_anti").select(*docs.columns)
    # a doc_id with several texts: each text has a verdict of its own
    stay = judged.filter("kept").join(again, "doc_id", "left_semi").select(
        "doc_id", F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    repeated = _with_keys(docs.join(again, "doc_id", "left_semi").select(*docs.columns)).join(
        stay, ["doc_id", "_k1", "_k2"], "left_semi").dropDuplicates(["doc_id", "_k1", "_k2"])
    return once.unionByName(repeated.select(*docs.columns))
