"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (decontamination, hard_negatives, language, licenses, mixing, prefix_trie, simhash, substrings,
               suffix_dedup, token_counts, token_files, toxicity, vectors)
from .common import hashed_fold, table

END_ID = 2
TOKEN_LIMIT = 1024


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = hashed_fold(F.col("doc_id"), 5)
    scored = toxicity.toxic_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                      table(spark, sf_dir, "labels"), fold != 0)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(), END_ID)
    return token_files.with_checksums(token_files.read_tokens(spark, path))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = hashed_fold(F.col("doc_id"), 4)
    found = language.identify(docs, language.fit(docs, fold != 2))
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    paths = prefix_trie.turn_paths(table(spark, sf_dir, "conversations"), c - c % 5, hashed_fold(c, 9))
    return prefix_trie.prefix_trie(paths)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", shifted.alias("label"), "embedding")
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_licenses, op3_embedding_dedup, op4_simhash, op5_substring_dedup,
                            op6_token_counts, op7_toxicity, op8_token_files, op9_language, op10_decontamination,
                            op11_prefix_trie, op12_hard_negatives, op13_suffix_dedup)}
