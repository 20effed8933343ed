"""Quality rules as a ledger of bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per rule,
set where it fails. Policies are versions: sets of rules as a mask. Applying one, comparing two or
asking what each rule costs only looks at the bits, never at a text again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
REPEAT = 3  # words of the windows whose repeats are counted

# Rules in the order of their bits: a bit never changes its meaning, new rules go to the end.
# Shares are written as products of whole numbers, so that no rounding decides.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "few_letters": "100 * n_letters < 50 * word_chars",
    "digits": "100 * n_digits > 30 * word_chars",
    "bullets": "100 * n_bullet_lines > 90 * n_lines",
    "ellipses": "100 * n_ellipsis_lines > 50 * n_lines",
}

# Versions of the policy. A released version stays as it is.
POLICIES = {
    "1": ("few_words", "repeated_words"),
    "2": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "3": tuple(RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
            "n_digits", "n_bullet_lines", "n_ellipsis_lines")


def mask(rules: tuple[str, ...] | str) -> int:
    """The bits of some rules, or of a version of the policy."""
    order = list(RULES)
    return sum(1 << order.index(r) for r in (POLICIES[rules] if isinstance(rules, str) else rules))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeated(windows: Column) -> Column:
    """Words covered by the windows that are found twice or more."""

    def of_sorted(s):
        same = F.filter(s, lambda e, i: e["x"].eqNullSafe(F.get(s, i - 1)["x"]) | e["x"].eqNullSafe(F.get(s, i + 1)["x"]))
        return _let(F.sort_array(F.transform(same, lambda e: e["i"])), of_places)

    def of_places(p):
        new = F.transform(p, lambda at, i: F.least(F.lit(REPEAT), F.coalesce(F.get(p, i + 1) - at, F.lit(REPEAT))))
        return F.aggregate(new, F.lit(0), lambda a, n: a + n)

    placed = F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _let(F.sort_array(placed), of_sorted)).otherwise(0)


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words whose sequence the text holds twice or more.

    Windows are compared as strings, not as hashes; sorting brings equal ones together.
    """

    def of_words(w):
        starts = F.slice(w, 1, F.size(w) - (REPEAT - 1))
        windows = F.transform(
            starts, lambda x, i: F.concat_ws(" ", x, *(F.get(w, i + k) for k in range(1, REPEAT))))
        return F.when(F.size(w) > REPEAT, _let(windows, _repeated)).otherwise(0)

    return _let(words, of_words)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns named by ``keep`` and the measurements, all long."""
    given = docs.select("doc_id", *keep, F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    t, first = F.col("_t"), F.substring("_t", 1, 1)
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    solid = _without(t, SPACES)

    def lines(full):
        return F.struct(
            F.size(full).alias("n_lines"),
            (F.size(full) - F.size(F.array_distinct(full))).alias("n_dup_lines"),
            F.size(F.filter(full, lambda x: F.ltrim(x).rlike("^[-*•]"))).alias("n_bullet_lines"),
            F.size(F.filter(full, lambda x: F.rtrim(F.translate(x, "\r", "")).rlike(r"(\.\.\.|…)$"))).alias("n_ellipsis_lines"),
        )

    def counted(w):
        return F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    full = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = given.select(
        "doc_id", *keep,
        _let(words, counted).alias("_w"),
        _let(full, lines).alias("_l"),
        F.length(solid).alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).alias("n_symbols"),
        (F.length(t) - F.length(_without(t, "0123456789"))).alias("n_digits"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{L}+", ""))).alias("n_letters"),
    ).select("*", "_w.*", "_l.*")
    return found.select("doc_id", *keep, *(F.col(c).cast("bigint").alias(c) for c in MEASURES))


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per document: the measurements, and ``failed`` with a bit for every rule that fails.

    A null text counts as an empty one, which has no words. Rows are looked at one by one, so repeated
    rows and rows without doc_id have their own lines; an empty table gives an empty ledger; other
    columns are left out unless ``keep`` names them, and never looked at.
    """
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(0).cast("bigint") for i, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured(docs, *keep).withColumn("failed", failed)


def verdicts(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``policy`` and ``kept``: whether no rule of that version fails."""
    bits = F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("bigint"))
    return entries.withColumns({"policy": F.lit(policy), "kept": bits == 0})


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: ``rule, n_failed, n_only, n_kept, n_kept_without``.

    ``n_only`` are the documents that this rule alone drops. Documents are counted per pattern of bits
    first, so at most two to the power of the number of rules move, whatever the number of documents.
    """
    bits = F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("bigint"))
    patterns = entries.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("bigint").alias("bit")) for r in POLICIES[policy])))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")

    def count(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("rule", "bit").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("bit")).alias("n_only"),
        count(F.col("bits") == 0).alias("n_kept"),
        count((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("n_kept_without"),
    ).drop("bit")


def changes(entries: DataFrame, old: str, new: str) -> DataFrame:
    """``doc_id, kept_before, kept_after, failed`` of the documents on which two versions differ."""
    before = F.col("failed").bitwiseAND(F.lit(mask(old)).cast("bigint")) == 0
    after = F.col("failed").bitwiseAND(F.lit(mask(new)).cast("bigint")) == 0
    return entries.where(before != after).select(
        "doc_id", before.alias("kept_before"), after.alias("kept_after"), "failed")
