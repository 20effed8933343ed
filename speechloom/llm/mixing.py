"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source whose share of all bytes should change by a rate gets copies of each document from a
Poisson distribution with that rate as its mean: a uniform number from the seeded hash of doc_id is
looked up in the distribution's running sums. Copies are dealt out by a hash and sorted by it, which
puts the whole corpus in random order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from speechloom.workspace import written

SEED = "mix-1"
EXPONENT = 0.5


def uniform(*parts: F.Column) -> F.Column:
    """52 bits of the MD5 of the joined parts as a number in [0, 1)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def source_rates(docs: DataFrame, *, weights: DataFrame | None = None, exponent: float = EXPONENT,
                 budget: float = 1.0) -> DataFrame:
    """``source, n_bytes, rate``: copies per document that bring a source to its share of the mix.

    The mix has ``budget`` times the bytes of the input. Shares are proportional to ``weights``
    (``source, weight``; a source without one gets none), by default to the source's bytes to the
    power ``exponent``. A source without bytes keeps each document once.
    """
    size = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n_bytes"))
    if weights is None:
        sized = size.withColumn("weight", F.pow(F.col("n_bytes").cast("double"), F.lit(exponent)))
    else:
        w = weights.select(F.col("source").alias("s"), F.col("weight").cast("double"))
        sized = size.join(w, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").fillna(0.0, ["weight"])
    sized = written(sized.withColumn("weight", F.when(F.col("n_bytes") > 0, F.col("weight")).otherwise(0.0)), "sizes")
    total = sized.agg(F.sum("n_bytes").alias("all_bytes"), F.sum("weight").alias("all_weights"))
    rate = F.col("weight") / F.col("all_weights") * F.col("all_bytes") * F.lit(float(budget)) / F.col("n_bytes")
    return sized.join(F.broadcast(total)).select(  # one row
        "source", "n_bytes", F.when(F.col("n_bytes") > 0, rate).otherwise(F.lit(1.0)).alias("rate"))


def poisson_sums(rates: DataFrame) -> DataFrame:
    """``source, sums``: running sums of the Poisson probabilities of 0, 1, 2 and so on, far into the tail."""
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 20)
    by_k = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    k = F.col("k").cast("double")
    log_p = F.when(F.col("k") == 0, -F.col("rate")).otherwise(-F.col("rate") + k * F.log("rate") - F.col("log_fact"))
    grid = rates.filter("rate > 0").select("source", "rate", F.explode(F.sequence(F.lit(0), most)).alias("k"))
    sums = (
        grid.withColumn("log_fact", F.sum(F.log(F.greatest(k, F.lit(1.0)))).over(by_k))
        .withColumn("cdf", F.sum(F.exp(log_p)).over(by_k))
    )
    # as many entries per source as its rate asks for, whatever the number of documents
    return sums.groupBy("source").agg(F.sort_array(F.collect_list("cdf")).alias("sums"))


def mix(docs: DataFrame, *, weights: DataFrame | None = None, exponent: float = EXPONENT, budget: float = 1.0,
        seed: str = SEED) -> DataFrame:
    """Copies of the rows, all columns kept, with ``copy`` (from 1) and ``order_key``, in the order of the mix.

    Equal doc_ids get equal counts; a null doc_id counts as an empty one, and rows with a null source
    are a source of their own. An empty table gives no rows; columns named like the added ones are
    replaced.
    """
    docs = docs.drop("copy", "order_key")
    sums = written(poisson_sums(source_rates(docs, weights=weights, exponent=exponent, budget=budget)), "sums")
    dealt = docs.join(sums.withColumnRenamed("source", "mix_source"), F.col("source").eqNullSafe(F.col("mix_source")))
    u = uniform(F.lit(seed), F.col("doc_id"))
    n = F.size(F.filter("sums", lambda s: s <= u))
    copies = dealt.withColumn("copy", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)))).select(
        *docs.columns, "copy", uniform(F.lit(seed), F.col("doc_id"), F.col("copy")).alias("order_key"))
    return copies.repartition("order_key").sortWithinPartitions("order_key", "copy")
