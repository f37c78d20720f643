"""The named queries of the operators: each applies one operator to its whole table and derives
the digest columns from the operator's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, hard_negatives, host_quality, langid, line_dedup, ngram_join, packing, pii, prefix_trie,
               quote_links, token_counts, topk, toxicity)
from .common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    joined = F.array_join(F.transform("pii", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")

    def of_kind(kind: str):
        return F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return found.select(
        "doc_id", *(of_kind(k).alias(f"n_{k}") for k in pii.BASE_KINDS),
        "base_sha256", joined.alias("spans"),
        F.size(F.filter("pii", lambda s: ~s["base"])).cast("long").alias("n_added"),
        F.aggregate("pii", F.lit(0.0), lambda a, s: F.greatest(a, s["score"])).alias("max_score"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn_profiles(docs))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link_quotes(table(spark, sf_dir, "conversations"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), unit="sentence")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.judge(table(spark, sf_dir, "documents"), domain="source")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "host_failed", "kept")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved)
    found = hard_negatives.mine(vectors, vectors.where(F.col("vec_id") % 100 == 0), positives=5, k=10, low=30, high=90)
    return found.drop("positive_rank")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    heads = F.crc32(c.cast("string").cast("binary")) % 4
    trie = prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), base=c - c % 20, heads=heads, max_heads=3)
    return trie.drop("key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_benchmark_decontamination, op2_exact_topk, op3_pii, op4_toxicity, op5_language_id,
                            op6_chat_formatting, op7_packing, op8_ngram_jaccard, op9_token_counts, op10_line_dedup,
                            op11_quality_rules, op12_hard_negatives, op13_prefix_trie)
}
