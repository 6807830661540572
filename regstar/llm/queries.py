"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.llm import kneser_ney, toxicity
from regstar.llm.merkle import manifest, path_digest
from regstar.llm.minhash import fingerprint_documents
from regstar.llm.minimax_shards import shard_documents
from regstar.llm.multi_index import hard_negatives
from regstar.llm.oracles import ORACLE_SQL
from regstar.llm.packing import pack_documents
from regstar.llm.pfair import mix
from regstar.llm.pii import BASE_KINDS, count_of, find_spans, told
from regstar.llm.quality import BASE, RULES, judge
from regstar.llm.shared import columns
from regstar.llm.simhash import near_duplicates
from regstar.llm.super_kmers import dedup_substrings
from regstar.llm.url_filters import UrlRule, judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return columns(_table(spark, sf_dir, "documents"), *names)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _remainder(doc_id: Column, divisor: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


URL_RULES = (
    UrlRule("allow", "com/"),
    UrlRule("block", "example.com/en/"),
    UrlRule("allow", "www.example.com/en/"),
    UrlRule("block", "net/es/"),
    UrlRule("block", "net/fr/"),
)

#: Whole shares by source: the largest source is held below its share of the
#: documents, the others alternate.
SOURCE_SHARES = {"src0": 10} | {f"src{i}": 4 if i < 10 else 3 for i in range(1, 20)}


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(columns(_table(spark, sf_dir, "pages"), "page_id", "url", "html"), URL_RULES)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir, "doc_id", "text"), shingle=3, max_bits=3)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    found = find_spans(docs, docs["doc_id"])
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, told(F.col("spans")).alias("spans"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = judge(_documents(spark, sf_dir, "doc_id", "text"), RULES, always=base)
    fails = [f"({rule.fails})" for rule in RULES if rule.name in BASE]
    return judged.select("doc_id", *base, F.expr(" OR ".join(fails)).alias("base_failed"), "kept")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf_dir, "doc_id", "text"), shingle=5)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_documents(
        _documents(spark, sf_dir, "doc_id", "text"), lambda doc_id: _remainder(doc_id, 7) == 2, order=3
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir, "doc_id", "source"), SOURCE_SHARES, other_weight=1, block=16)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(
        _documents(spark, sf_dir, "doc_id", "text"),
        _table(spark, sf_dir, "labels"),
        lambda doc_id: _remainder(doc_id, 3) != 1,
    )
    held_out = F.coalesce(_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_documents(spark, sf_dir, "doc_id", "text"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir, "doc_id", "text"), tokenizer_path()).drop("ids")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_documents(spark, sf_dir, "doc_id", "text"), k=13)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(_remainder(F.col("doc_id"), 2) == 0, F.translate("text", "\n", ""))
    proven = manifest(docs, tampered=tampered)
    return proven.select(
        "doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified"
    )


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_quality_rules": op4_quality_rules,
    "op5_fingerprints": op5_fingerprints,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
