"""URL filter by host reputation: beta-binomial shrinkage from suffix to registered domain to host.

Labelled pages of a host are good or bad. Each level's good rate is shrunk towards its parent's, as
strongly as the spread between the groups of that level suggests; a host is blocked when even the
upper bound of its posterior good rate is too low. Explicit rules come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechloom.workspace import written

# Rules (host, path, verdict) of the production list.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Public suffixes of two labels.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz", "com.mx", "co.in", "com.ar")
LEAST_GOOD = 0.5
Z = 1.645

# (?s): hosts and paths may hold line breaks
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: F.Column) -> F.Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: F.Column) -> F.Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def rule_of(rules: Sequence[tuple[str, str, str]], value: int | None = None) -> F.Column:
    """The longest rule that fits ``host`` and ``path``: its string, or the given field of it; else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):
        host, path = rule[0], rule[1]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(host + path if value is None else rule[value])).otherwise(out)
    return out


def _suffix(host: F.Column) -> F.Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*DOUBLE_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def _domain(host: F.Column) -> F.Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*DOUBLE_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(groups: DataFrame) -> DataFrame:
    """One row ``kappa``: prior strength from how much more than binomially groups (n, x) spread around ``prior``."""
    n, x, m = F.col("n"), F.col("x"), F.col("prior")
    v = m * (1 - m)
    spread = groups.agg(
        F.sum((x - n * m) * (x - n * m)).alias("s"), F.sum(n * v).alias("b"), F.sum(n * (n - 1) * v).alias("d"))
    rho = F.when(F.col("d") > 0, (F.col("s") - F.col("b")) / F.col("d")).otherwise(0.0)
    rho = F.least(F.greatest(rho, F.lit(0.001)), F.lit(0.9))
    return spread.select((1 / rho - 1).alias("kappa"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Adds ``kappa`` and the posterior mean ``mean`` to groups with ``n, x, prior``."""
    kappa = F.broadcast(_strength(groups))  # one row
    return groups.join(kappa).withColumn(
        "mean", (F.col("x") + F.col("kappa") * F.col("prior")) / (F.col("n") + F.col("kappa")))


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, n, x, mean, upper`` of every host: labelled pages, good ones, posterior mean and bound.

    A label belongs to the page whose page_id is its doc_id; quality 1 without toxicity is good. A
    page labelled several times is good only if every label is. Labels without id or quality don't count.
    """
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("bigint")
    known = labels.filter("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").alias("page_id")).agg(F.min(good).alias("good"))
    hosts = written(
        pages.select("page_id", host_of(F.col("url")).alias("host")).join(known, "page_id", "left")
        .groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("x"))
        .select("host", _domain(F.col("host")).alias("domain"), _suffix(F.col("host")).alias("suffix"), "n", "x"),
        "hosts")
    counts = (F.sum("n").alias("n"), F.sum("x").alias("x"))
    top = hosts.agg(((F.coalesce(F.sum("x"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("prior"))
    suffixes = written(_shrunk(hosts.groupBy("suffix").agg(*counts).join(F.broadcast(top))), "suffixes")
    domains = written(_shrunk(
        hosts.groupBy("domain", "suffix").agg(*counts)
        .join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")), "domains")
    judged = _shrunk(hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain"))
    m, weight = F.col("mean"), F.col("n") + F.col("kappa")
    return judged.select("host", "n", "x", "mean", (m + Z * F.sqrt(m * (1 - m) / (weight + 1))).alias("upper"))


def judge_urls(pages: DataFrame, labels: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES,
               least_good: float = LEAST_GOOD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    A url that is null or has no ``://`` has an empty host, which is judged like any other. Without
    labels every host has the prior and is allowed; repeated rows are judged alike; an empty table
    gives no rows; other columns are not looked at.
    """
    # a host may hold a third of all pages: both sides are exchanged, so Spark can split its partition
    reputation = written(host_reputation(pages, labels), "reputation").select(
        "host", F.when(F.col("upper") < least_good, "block").otherwise("allow").alias("own"))
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return urls.join(reputation, "host", "left").select(
        "page_id", "host", "path", rule_of(rules).alias("rule"),
        F.coalesce(rule_of(rules, 2), "own").alias("verdict"))
