"""Hard negatives by exact integer scores from subset-sum tables.

Components become whole numbers. Of eight components at a time an anchor has only 256 sums of some of
them, which are tabulated once. A candidate keeps its numbers as bit planes, a byte for every eight
components, and each such byte is the index of a sum: adding up the looked-up sums of a plane, and the
planes by doubling, gives the whole inner product without a multiplication and without rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from speechloom.workspace import written

SHARD_ROWS = 32_768  # candidates of one group
BLOCK_ROWS = 8_192  # anchors of one group
CHUNK_ROWS = 8_192  # candidates scored at a time
ANCHORS = 64  # anchors scored at a time

PACKED = "vec_id bigint, label int, size int, planes binary"
POSITIVES = "anchor_id bigint, positive_id bigint, positive_score bigint"
NEGATIVES = POSITIVES + ", negative_id bigint, negative_score bigint"


def quantized(vectors: DataFrame, scale: float) -> DataFrame:
    """``vec_id, label, v`` with whole numbers ``floor(scale * x)`` for each component.

    Rows without id, label or vector and those with a null or non-finite component, or one whose whole
    number is beyond a long, are left out; of an id with several rows the smallest label, then vector.
    """
    x = F.col("embedding").cast("array<double>")
    fits = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v * scale) < 2.0**63), F.lit(False)))
    whole = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fits).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.transform(x, lambda v: F.floor(v * scale)).alias("v"))
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def planes_needed(rows: DataFrame) -> int:
    """Bits of the largest number, with one for the sign."""
    size = F.array_max(F.transform("v", lambda x: F.when(x < 0, F.bitwise_not(x)).otherwise(x)))
    return int(rows.agg(F.max(size)).first()[0] or 0).bit_length() + 1


def pack(v: np.ndarray, n_planes: int) -> np.ndarray:
    """Bit planes of a matrix of whole numbers: (row, plane, group of eight components) as bytes."""
    out = np.empty((len(v), n_planes, -(-v.shape[1] // 8)), np.uint8)
    for b in range(n_planes):
        out[:, b] = np.packbits((v >> b & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def unpack(planes: np.ndarray, size: int) -> np.ndarray:
    """The whole numbers again; the last plane holds the signs."""
    bits = np.unpackbits(planes, axis=2, count=size, bitorder="little").astype(np.int64)
    weight = np.left_shift(np.int64(1), np.arange(planes.shape[1], dtype=np.int64))
    weight[-1] = -weight[-1]
    return np.einsum("rpc,p->rc", bits, weight)


def packed(rows: DataFrame, n_planes: int) -> DataFrame:
    """``vec_id, label, size, planes``: the candidates as they are looked up with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            flat, begin = v.flatten().to_numpy(zero_copy_only=False), v.offsets.to_numpy() - v.offsets[0].as_py()
            out: list[bytes] = [b""] * len(sizes)
            for size in np.unique(sizes[sizes > 0]):
                of_size = np.flatnonzero(sizes == size)
                at = begin[of_size][:, None] + np.arange(size)
                for i, row in zip(of_size, pack(flat[at], n_planes)):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())],
                ["vec_id", "label", "size", "planes"])

    return rows.select("vec_id", "label", "v").mapInArrow(run, PACKED)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(group, subset as a byte, anchor): the sum of every subset of every eight components."""
    n, size = anchors.shape
    groups = -(-size // 8)
    full = np.zeros((n, groups * 8), kind)
    full[:, :size] = anchors
    sums = np.zeros((groups, 1, n), kind)
    for j in range(8):
        sums = np.concatenate([sums, sums + full[:, j::8].T[:, None, :]], axis=1)
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor): inner products from looked-up sums, doubled from plane to plane."""
    n, n_planes, groups = planes.shape
    total = np.zeros((n, sums.shape[2]), sums.dtype)
    found = np.empty_like(total)
    shared = min(groups, len(sums))  # of a shorter vector the missing components count as zero
    index = np.ascontiguousarray(planes[:, :, :shared].transpose(1, 2, 0)).astype(np.intp)
    for b in reversed(range(n_planes)):
        total += total
        for g in range(shared):
            np.take(sums[g], index[b, g], axis=0, out=found, mode="clip")
            if b == n_planes - 1:
                total -= found
            else:
                total += found
    return total


class Tile:
    """Candidates of a group, by number of components, each part ordered by label and id."""

    def __init__(self, table: pa.Table, n_planes: int):
        ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
        sizes = table["size"].to_numpy()
        order = np.lexsort((ids, labels, sizes))
        self.parts = []
        for size in np.unique(sizes):
            at = order[sizes[order] == size]
            raw = b"".join(table["planes"].take(pa.array(at)).to_pylist())
            planes = np.frombuffer(raw, np.uint8).reshape(len(at), n_planes, -(-int(size) // 8))
            self.parts.append((int(size), ids[at], labels[at], planes))

    def anchors(self) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Ids, label and numbers of anchors of one label and size."""
        for size, ids, labels, planes in self.parts:
            for label in np.unique(labels):
                own = np.flatnonzero(labels == label)
                for at in range(0, len(own), ANCHORS):
                    some = own[at:at + ANCHORS]
                    yield ids[some], int(label), unpack(planes[some], size)

    def scored(self, label: int, same: bool, anchors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores, chunk by chunk, of the candidates with that label or with any other."""
        largest = int(np.abs(anchors.astype(object)).max()) if anchors.size else 0
        for size, ids, labels, planes in self.parts:
            bound = largest * min(size, anchors.shape[1]) << planes.shape[1]
            sums = subset_sums(anchors, np.int32 if bound < 1 << 30 else np.int64)
            rows = np.flatnonzero((labels == label) == same)
            for at in range(0, len(rows), CHUNK_ROWS):
                some = rows[at:at + CHUNK_ROWS]
                yield ids[some], scores(sums, planes[some]).astype(np.int64)


def leading(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each key: largest score, then smallest id."""
    order = np.lexsort((ids, -score.astype(np.int64), key))
    first = np.r_[True, key[order][1:] != key[order][:-1]] if len(order) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else np.empty(0, int)
    return order[np.arange(len(order)) - begin < k]


def _joined(found: list[tuple[np.ndarray, ...]], width: int) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * width


def _table(columns: list[np.ndarray], schema: str) -> pa.Table:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=names)


def positives_of(table: pa.Table, asked: pa.Table, n_planes: int, k: int) -> pa.Table:
    """Each anchor's first ``k`` among a tile's other rows of its label."""
    found = []
    if table.num_rows and asked.num_rows:
        tile = Tile(table, n_planes)
        for anchor_ids, label, numbers in Tile(asked, n_planes).anchors():
            for ids, score in tile.scored(label, True, numbers):
                least = np.partition(score, -min(k + 1, len(score)), axis=0)[-min(k + 1, len(score))]
                row, col = np.nonzero(score >= least)  # the anchor itself may be among them
                other = ids[row] != anchor_ids[col]
                row, col = row[other], col[other]
                best = leading(col, score[row, col], ids[row], k)
                found.append((anchor_ids[col[best]], ids[row[best]], score[row[best], col[best]]))
    columns = _joined(found, 3)
    best = leading(columns[0], columns[2], columns[1], k)
    return _table([c[best] for c in columns], POSITIVES)


def negatives_of(table: pa.Table, asked: pa.Table, n_planes: int, k: int, low: int, high: int) -> pa.Table:
    """For each anchor and positive the first ``k`` of a tile's rows of other labels within the limits."""
    found = []
    if table.num_rows and asked.num_rows:
        tile = Tile(table, n_planes)
        positives = dict(zip(asked["vec_id"].to_pylist(), asked["positives"].to_pylist()))
        for anchor_ids, label, numbers in Tile(asked, n_planes).anchors():
            wanted = []  # anchor's place, positive, its score, least and largest score
            for col, anchor in enumerate(anchor_ids.tolist()):
                for p in positives[anchor]:
                    s = p["positive_score"]
                    wanted.append((col, p["positive_id"], s, -(-low * s // 100), high * s // 100))
            reach = [[x for x in wanted if x[0] == col and x[3] <= x[4]] for col in range(len(anchor_ids))]
            most, least = np.iinfo(np.int64).max, np.iinfo(np.int64).min
            lo = np.array([min((x[3] for x in r), default=most) for r in reach], np.int64)
            hi = np.array([max((x[4] for x in r), default=least) for r in reach], np.int64)
            for ids, score in tile.scored(label, False, numbers):
                col, row = np.nonzero(((score >= lo) & (score <= hi)).T)
                order = np.lexsort((ids[row], -score[row, col], col))
                col, row = col[order], row[order]
                begin = np.searchsorted(col, np.arange(len(anchor_ids) + 1))
                for c, positive, s, least_score, largest_score in wanted:
                    some = row[begin[c]:begin[c + 1]]
                    falling = -score[some, c]
                    at = np.searchsorted(falling, -largest_score)
                    some = some[at:min(at + k, np.searchsorted(falling, -least_score, "right"))]
                    if len(some):
                        n = len(some)
                        found.append((np.full(n, anchor_ids[c]), np.full(n, positive), np.full(n, s),
                                      ids[some], score[some, c]))
    columns = _joined(found, 5)
    _, key = np.unique(np.column_stack(columns[:2]), axis=0, return_inverse=True)
    best = leading(key.reshape(-1), columns[4], columns[3], k)
    return _table([c[best] for c in columns], NEGATIVES)


def hard_negatives(vectors: DataFrame, *, scale: float = 256.0, every: int = 50, positives: int = 5,
                   negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Rows of another label that score nearly as high as an anchor's own positives.

    ``vectors(vec_id, label, embedding)``; anchors are the rows whose id ``every`` divides, and are scored
    against all rows. An anchor's positives are its first ``positives`` other rows of its label; for each,
    the first ``negatives`` rows of other labels whose score is from ``low`` to ``high`` percent of the
    positive's: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. The score is
    the inner product of whole numbers, exact whenever it fits into a long; ties go to the smaller id.

    Rows that ``quantized`` leaves out take no part; of repeated ids one row counts; missing components of
    a shorter vector count as zero; an anchor without positives or negatives, and an empty table, give no
    rows; other columns are not looked at.

    Anchors and candidates meet in groups of bounded size, and every group hands on only its first few, so
    what is shuffled besides is a copy of the anchors per shard and of the candidates per block of anchors.
    """
    spark = vectors.sparkSession
    rows = quantized(vectors, scale)
    n_planes = planes_needed(rows)
    known = written(packed(rows, n_planes), "planes")
    asked = written(known.where(F.col("vec_id") % every == 0), "anchors")
    n, m = known.count(), asked.count()
    if not n or not m:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    shards = max(-(-n // SHARD_ROWS), min(2 * spark.sparkContext.defaultParallelism, -(-n // 1024)))
    blocks = -(-m // BLOCK_ROWS)

    def own(parts: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    candidates = known.withColumn("shard", own(shards, 1)).withColumn("block", each(blocks)).groupBy("shard", "block")

    def met(anchors: DataFrame):
        placed = anchors.withColumn("block", own(blocks, 2)).withColumn("shard", each(shards))
        return candidates.cogroup(placed.groupBy("shard", "block"))

    def first(df: DataFrame, k: int, score: str, vec_id: str, *key: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(score), vec_id))
        return df.withColumn("rank", place).where(F.col("rank") <= k)

    near = met(asked).applyInArrow(lambda t, a: positives_of(t, a, n_planes, positives), POSITIVES)
    near = written(first(near, positives, "positive_score", "positive_id", "anchor_id").drop("rank"), "positives")
    # at most `positives` structs per anchor
    listed = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    found = met(asked.join(listed, "vec_id")).applyInArrow(
        lambda t, a: negatives_of(t, a, n_planes, negatives, low, high), NEGATIVES)
    return first(found, negatives, "negative_score", "negative_id", "anchor_id", "positive_id").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
