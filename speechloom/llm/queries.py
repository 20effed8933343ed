"""Registered queries of the operators; SQL counterparts are in ``oracle.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.llm.common import table
from speechloom.llm.hard_negatives import hard_negatives
from speechloom.llm.language_id import identify
from speechloom.llm.minhash import near_duplicates
from speechloom.llm.mixing import mix
from speechloom.llm.packing import pack
from speechloom.llm.permutation_index import nearest
from speechloom.llm.pii import find
from speechloom.llm.projection_forest import near_vectors
from speechloom.llm.quality_rules import ledger, mask, verdicts
from speechloom.llm.substrings import remove_repeats
from speechloom.llm.structure_repair import COUNTS, digests, repair
from speechloom.llm.url_reputation import judge_urls
from speechloom.llm.warc import payloads, write_warc
from speechloom.workspace import fresh_dir, written

BASE, POLICY = "1", "3"  # versions of the quality policy


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", "copy", "order_key", "text")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return payloads(spark, path)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row gets a wrong label first."""
    vectors = table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", wrong))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults dealt out by a checksum; one in twenty each is dropped, emptied, cut, repeated or renamed."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv_id, turn, role, text = columns
    code = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    kept = turns.select("conv_id", "turn", code.alias("code"), role.alias("role"), text.alias("text")).where("code != 0")
    return kept.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    done = digests(written(repair(damaged(turns)), "parts")).withColumnRenamed("conv_id", "repaired_id")
    every = turns.select("conv_id").distinct()
    told = every.join(done, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left")
    return told.select(
        "conv_id", *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is written, as it is a table to keep; the policy in force is applied to what was written."""
    entries = written(ledger(table(spark, sf_dir, "documents")), "ledger")
    judged = verdicts(entries, POLICY)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(mask(BASE)).cast("bigint")) != 0).alias("base_failed"), "kept", "failed")


QUERIES = {
    "op1_url_reputation": op1_url_reputation,
    "op2_pii": op2_pii,
    "op3_mixing": op3_mixing,
    "op4_minhash": op4_minhash,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_substrings": op6_substrings,
    "op7_permutation_index": op7_permutation_index,
    "op8_projection_forest": op8_projection_forest,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_structure_repair": op12_structure_repair,
    "op13_quality_rules": op13_quality_rules,
}
