"""Nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Each shard of the table posts its
vectors in inverted files, one per pivot, holding the pivot's place in their order. A query reads
the files of its own nearest pivots, ranks what it meets by the footrule distance between the two
orders, and the best are ranked anew by their inner product. One more component, which raises vectors
to a common length and is 0 in queries, makes the angle follow the inner product; the longest vectors
of each shard, which it can't raise, are always ranked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from speechloom.llm.vectors import dimension, matrix, sample, unit, usable
from speechloom.workspace import written

PIVOTS = 256
PREFIX = 64
SHARE = 0.15
LONGEST = 0.05
SHARD_ROWS = 8192
BLOCK_ROWS = 2048
FOUND = "query_id bigint, vec_id bigint, score double"


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the ``prefix`` nearest pivots of each row, nearest first."""
    return np.argsort(-(unit(x) @ pivots.T), axis=1, kind="stable")[:, :prefix]


def lengths(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def raised(x: np.ndarray, length: float) -> np.ndarray:
    """``x`` with one more component that gives rows of at most ``length`` just that length."""
    return np.column_stack([x, length * np.sqrt(np.maximum(1 - (lengths(x) / length) ** 2, 0))])


class Index:
    """Inverted files of one shard: for each pivot the rows that have it in their order, and its place there."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        n, self.prefix = order.shape
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.rows = by_pivot // self.prefix
        self.weight = self.prefix - by_pivot % self.prefix
        self.begin = np.searchsorted(flat[by_pivot], np.arange(n_pivots + 1))
        self.n = n

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distances of all rows to a query's order; a pivot outside an order stands right behind it.

        |a - b| over all pivots is what both orders weigh, less twice the smaller weight of shared pivots.
        """
        files = [slice(self.begin[p], self.begin[p + 1]) for p in order]
        rows = np.concatenate([self.rows[f] for f in files])
        common = np.concatenate([np.minimum(self.weight[f], self.prefix - i) for i, f in enumerate(files)])
        whole = self.prefix * (self.prefix + 1)
        return whole - 2 * np.bincount(rows, common, self.n)


def nearest(vectors: DataFrame, *, k: int = 20, every: int = 20, n_pivots: int = PIVOTS, prefix: int = PREFIX,
            share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for every ``every``-th id.

    Queries are the rows whose vec_id ``every`` divides; candidates are all other rows. ``share`` of each
    shard's rows, nearest by footrule, are ranked by inner product, or 50 ``k`` if that is more, and
    with them the longest rows (``LONGEST``). Ties
    go to the smaller id. Unusable vectors take no part, nor do vectors of another than the commonest
    number of components or without id; of repeated ids one counts; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    known = written(usable(vectors), "vectors")
    d = dimension(known)
    known = known.filter(F.size("embedding") == d)
    asked = known.filter(F.col("vec_id") % every == 0)
    n, m = known.count(), asked.count()
    if not n or not m:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    some = sample(known, 4 * n_pivots)  # bounded: at most 4 n_pivots vectors
    length = float(np.quantile(lengths(some), 1 - LONGEST))
    pivots = unit(raised(some[:n_pivots], length))
    prefix = min(prefix, len(pivots))
    shards, blocks = -(-n // SHARD_ROWS), -(-m // BLOCK_ROWS)

    def dealt(df: DataFrame, shard: F.Column, block: F.Column) -> DataFrame:
        return df.select("vec_id", "embedding", shard.alias("shard"), block.alias("block"))

    def own(parts: int, seed: int) -> F.Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")

    def each(parts: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    # a group holds one shard and one block of queries, both of bounded size
    left = dealt(known, own(shards, 1), each(blocks)).groupBy("shard", "block")
    right = dealt(asked, each(shards), own(blocks, 2)).groupBy("shard", "block")

    def search(table, queries):
        out: list[tuple] = []
        if table.num_rows and queries.num_rows:
            x, q = matrix(table["embedding"], d), matrix(queries["embedding"], d)
            ids, asked_ids = table["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            index = Index(orders(raised(x, length), pivots, prefix), len(pivots))
            longest = np.lexsort((ids, -lengths(x)))[:int(np.ceil(LONGEST * len(ids)))]
            most = min(len(ids), max(int(np.ceil(share * len(ids))), 50 * k + 1))
            flat = np.column_stack([q, np.zeros(len(q))])
            for query_id, query, order in zip(asked_ids, q, orders(flat, pivots, prefix)):
                near = np.argpartition(index.footrule(order), most - 1)[:most]
                near = np.union1d(near, longest)
                near = near[ids[near] != query_id]
                score = x[near] @ query
                best = np.lexsort((ids[near], -score))[:k]
                out.append((np.full(len(best), query_id), ids[near][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0)] * 3
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types)],
                        names=["query_id", "vec_id", "score"])

    found = left.cogroup(right).applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
