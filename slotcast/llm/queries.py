"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm import centroids, jaccard, mixing, negatives, neighbours, packing, quality, secrets, substrings, surrogates, tokens, toxicity, urls
from slotcast.llm.common import read


WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.concat_ws(",", each)

    return found.select(
        "doc_id",
        *map(count, secrets.BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), words=3, percent=90)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(read(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    ruled = quality.quality_rules(docs, read(spark, sf_dir, "labels"))
    return ruled.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, length=35).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, read(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(
        read(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=changed
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_surrogates": op2_surrogates,
    "op3_secrets": op3_secrets,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_url_filter": op5_url_filter,
    "op6_mixing": op6_mixing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_near_vectors": op9_near_vectors,
    "op10_quality_rules": op10_quality_rules,
    "op11_toxicity": op11_toxicity,
    "op12_centroids": op12_centroids,
    "op13_hard_negatives": op13_hard_negatives,
}
