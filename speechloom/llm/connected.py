"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.workspace import discard, fresh_dir, written_at

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every end of a link (``a, b``) that isn't its component's smallest id.

    Each step is written to the shared folder, so neither lineage nor plans grow with the rounds. A
    node's neighbours never meet in one place: minima are aggregated on the way, and what they are
    joined to is a written table, of which Spark can split a large partition.
    """
    spark = links.sparkSession
    folders: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        folders.append(fresh_dir(spark, "star"))
        return written_at(df, folders[-1])

    def directed(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges, before = keep(directed(links)), None
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        large = keep(directed(edges.join(low, edges.b == low.u).select(edges.a.alias("a"), F.col("m").alias("b"))))
        # small star: u and its smaller neighbours go to the smallest of them
        low = keep(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"))
        moved = large.join(low, large.a == low.u).select(large.b.alias("a"), F.col("m").alias("b"))
        edges = keep(directed(moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))))
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        for path in folders[:-1]:
            discard(spark, path)
        del folders[:-1]
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = now
    raise RuntimeError("components did not settle")
