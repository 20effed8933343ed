"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the space by random directions at medians; vectors close to a split go to both
sides. A narrow margin keeps copies few, and as many trees are grown as a pair at the threshold needs
to share a leaf of one of them. Depth follows the table: where the sample that trees are grown on ends,
splits go on through the centre of what it has there. Vectors that share a leaf of any tree are
compared in full, and links are united. A pair that shares several leaves counts in the first of them
alone, so links are counted without listing pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.llm.connected import components
from speechloom.llm.vectors import dimension, matrix, sample, unit, usable
from speechloom.workspace import written

COSINE = 0.9
MISS = 1e-4  # chance that a pair at the threshold shares no leaf
LEAF_ROWS = 128
BLOCK_ROWS = 2048
SAMPLE = 32_768
LEAST_SAMPLE = 16
SPILL = 0.1  # margin on either side of a split, as a share of the projections' deviation
TILE = 256

JUDGED = "rep bigint, n_links bigint, label bigint"


def trees_needed(n_rows: int, cosine: float = COSINE) -> int:
    """Trees in which all but ``MISS`` of the pairs at ``cosine`` share a leaf.

    A split parts a pair if the two lie beyond the margin on different sides; projections of unit
    vectors on random directions are close to normal.
    """
    apart = math.sqrt(max(2 * (1 - cosine), 1e-12))
    a = 2 * SPILL / apart
    beyond = math.exp(-a * a / 2) / math.sqrt(2 * math.pi) - a * math.erfc(a / math.sqrt(2)) / 2
    parted = min(2 * apart * beyond / math.sqrt(math.pi * max(1 + cosine, 1e-3)), 0.5)
    together = (1 - parted) ** max(math.log2(max(n_rows, 1) / LEAF_ROWS), 0)
    return max(2, math.ceil(math.log(MISS) / math.log1p(-min(together, 0.999))))


class Forest:
    """Directions, thresholds and children of all nodes; leaves are numbered over all trees.

    A leaf that the sample can split no further, though the table has too many rows for it, is split by
    ``extra`` more directions through the sample's centre there.
    """

    def __init__(self, x: np.ndarray, n_rows: int, cosine: float = COSINE, seed: int = 8):
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        self.margin = SPILL / np.sqrt(d)
        self.direction, self.cut, self.child, self.roots, self.n_leaves = [], [], [], [], 0
        self.extra: dict[int, tuple[int, np.ndarray]] = {}
        self.seed = seed
        per_row = n_rows / len(x)

        def grow(rows: np.ndarray) -> int:
            """A node's number, or a leaf's as -1 - number."""
            one = False
            if len(rows) * per_row > LEAF_ROWS and len(rows) >= 2 * LEAST_SAMPLE:
                direction = rng.standard_normal(d)
                direction /= np.sqrt(direction @ direction)
                p = x[rows] @ direction
                cut = float(np.median(p))
                left, right = rows[p <= cut], rows[p > cut]
                if len(left) and len(right):
                    at = len(self.cut)
                    self.direction.append(direction)
                    self.cut.append(cut)
                    self.child.append(None)
                    self.child[at] = (grow(left), grow(right))
                    return at
                one = True
            name = self.n_leaves
            levels = 0 if one else max(math.ceil(math.log2(max(len(rows), 1) * per_row / LEAF_ROWS)), 0)
            if levels:
                self.extra[name] = levels, x[rows].mean(axis=0)
            self.n_leaves += 1 << levels
            return -1 - name

        self.roots = [grow(np.arange(len(x))) for _ in range(trees_needed(n_rows, cosine))]

    def _further(self, leaf: int, x: np.ndarray, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Leaves of rows below a leaf of the sample."""
        levels, centre = self.extra[leaf]
        rng = np.random.default_rng([self.seed, leaf])
        found = [(0, rows)]
        for _ in range(levels):
            direction = rng.standard_normal(x.shape[1])
            direction /= np.sqrt(direction @ direction)
            cut, halves = centre @ direction, []
            for bits, own in found:
                p = x[own] @ direction - cut
                halves += [(2 * bits, own[p <= self.margin]), (2 * bits + 1, own[p > -self.margin])]
            found = [(bits, own) for bits, own in halves if len(own)]
        return [(leaf + bits, own) for bits, own in found]

    def leaves(self, x: np.ndarray) -> list[list[int]]:
        """Of each row, the leaves it falls or spills into, in order."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        todo = [(root, np.arange(len(x))) for root in self.roots]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                leaf = -1 - node
                for name, own in self._further(leaf, x, rows) if leaf in self.extra else [(leaf, rows)]:
                    for r in own.tolist():
                        out[r].append(name)
                continue
            p = x[rows] @ self.direction[node] - self.cut[node]
            left, right = self.child[node]
            todo += [(left, rows[p <= self.margin]), (right, rows[p > -self.margin])]
        return [sorted(v) for v in out]


def _classes(known: DataFrame) -> DataFrame:
    """Vectors that are equal are one class: ``h1, h2, rep, n``."""
    return known.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))


def _compare(cosine: float, d: int):
    def run(key, table):
        leaf, i, j = (int(v.as_py()) for v in key)
        ids, n = table["rep"].to_numpy(), table["n"].to_numpy().astype(np.float64)
        side = table["side"].to_numpy()
        x = unit(matrix(table["embedding"], d))
        a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
        # which earlier leaves each row is in
        lists = table["leaves"].combine_chunks()
        flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
        before = flat < leaf
        names, at = np.unique(flat[before], return_inverse=True)
        links, label = np.zeros(len(ids)), ids.copy()
        linked = []
        for lo in range(0, len(a), TILE):
            rows = a[lo:lo + TILE]
            near = x[rows] @ x[b].T >= cosine
            near &= ids[rows][:, None] != ids[b][None, :]
            p, q = near.any(axis=1), near.any(axis=0)
            if not p.any():
                continue
            rows, cols, near = rows[p], b[q], near[np.ix_(p, q)]
            if len(names):
                near &= ~_shared(rows, cols, row[before], at, len(names))
            linked.append((rows, cols, near))
            links[rows] += near @ n[cols]
            if i != j:
                links[cols] += n[rows] @ near
        changed = True
        while changed:
            changed = False
            for rows, cols, near in linked:
                low = np.where(near, label[cols][None, :], label[rows][:, None]).min(axis=1, initial=np.iinfo(np.int64).max)
                low = np.minimum(low, label[rows])
                other = np.minimum(np.where(near, low[:, None], label[cols][None, :]).min(axis=0), label[cols])
                if (low < label[rows]).any() or (other < label[cols]).any():
                    changed = True
                    label[rows] = low
                    label[cols] = np.minimum(label[cols], other)
        some = links > 0
        return pa.table({"rep": ids[some], "n_links": links[some].astype(np.int64), "label": label[some]})

    return run


def _shared(rows: np.ndarray, cols: np.ndarray, row: np.ndarray, leaf: np.ndarray, n_leaves: int) -> np.ndarray:
    """Which pairs of rows and cols are together in any of the leaves that (row, leaf) lists."""
    def members(of: np.ndarray) -> np.ndarray:
        place = np.full(row.max(initial=-1) + 1, -1)
        inside = of[of < len(place)]
        place[inside] = np.flatnonzero(of < len(place))
        out = np.zeros((len(of), n_leaves), np.float32)
        keep = place[row] >= 0
        out[place[row[keep]], leaf[keep]] = 1
        return out

    return members(rows) @ members(cols).T > 0


def near_vectors(vectors: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vec_id.

    Vectors link from ``cosine`` on, in double precision. Unusable vectors link with nothing and are
    their own component; so do, but for equal ones, vectors of another than the commonest number of
    components. Rows without vec_id link with nothing, have no component_id and are kept. Of an id with
    several vectors the smallest counts; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    known = written(usable(vectors).withColumns({
        "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit("second"), "embedding")}), "vectors")
    classes = written(_classes(known), "classes")
    d = dimension(known)
    reps = written(
        known.filter(F.size("embedding") == d).join(
            classes.select("h1", "h2", F.col("rep").alias("vec_id"), "n"), ["h1", "h2", "vec_id"]
        ).select(F.col("vec_id").alias("rep"), "n", "embedding"), "reps")
    n_rows = reps.count()
    judged = spark.createDataFrame([], JUDGED)
    if n_rows:
        # bounded sample; a tree has at most SAMPLE / LEAST_SAMPLE nodes
        forest = Forest(unit(sample(reps.withColumnRenamed("rep", "vec_id"), SAMPLE)), n_rows, cosine)
        kind = reps.schema["embedding"].dataType.simpleString()

        def drop(batches):
            for batch in batches:
                if batch.num_rows:
                    x = unit(matrix(batch.column("embedding"), d))
                    yield batch.append_column("leaves", pa.array(forest.leaves(x), pa.list_(pa.int64())))

        dropped = written(reps.mapInArrow(
            drop, f"rep bigint, n bigint, embedding {kind}, leaves array<bigint>"), "leaves").withColumn("leaf", F.explode("leaves"))
        # leaves that are still large, as of vectors that no direction tells apart, are compared in blocks
        sizes = written(dropped.groupBy("leaf").agg(F.count("*").alias("size")), "sizes").select(
            "leaf", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks"))
        sided = dropped.join(sizes, "leaf").withColumn(
            "side", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        paired = sided.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "leaf", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
            "side", "rep", "n", "embedding", "leaves")
        judged = written(paired.groupBy("leaf", "i", "j").applyInArrow(_compare(cosine, d), JUDGED), "judged")
    found = components(judged.filter("rep <> label").select(F.col("rep").alias("a"), F.col("label").alias("b")))
    counts = judged.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    named = (
        classes.join(counts, "rep", "left").join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .select("h1", "h2", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component"))
    )
    told = known.select("vec_id", "h1", "h2").join(named, ["h1", "h2"]).select("vec_id", "n_links", "component")
    ids = vectors.select(F.col("vec_id").cast("bigint"))
    every = ids.filter("vec_id is not null").distinct().unionByName(ids.filter("vec_id is null"))
    return every.join(told, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
