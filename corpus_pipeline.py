"""Training-data pipeline over ``documents``.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and works on all
documents that its predecessor kept; all but the last return the columns of ``documents``.
Between stages the documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm import jaccard, mixing, packing, quality, secrets
from slotcast.llm.common import fresh, join_small, read, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ruled = quality.quality_rules(docs, read(spark, sf_dir, "labels"))
    return ruled.where("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 % of their five-word shingles.

    Rows that share id and text are one document, whether or not the id is null. The one
    with the least id stays; null ids come last, and the text's hash decides between equal
    ids. Documents without shingles are in no group.
    """
    mark = fresh("_text_hash", docs.columns)
    key = ["doc_id", mark]
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    groups = staged(jaccard.jaccard_groups(keyed, words=5, percent=80, keys=[mark]), "groups")
    first = groups.where("comp is not null").groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull(), *key)).alias("first")
    )
    same = [F.col(f"first.{c}").eqNullSafe(F.col(c)) for c in key]
    copies = staged(
        groups.join(first, "comp").where(~(same[0] & same[1])).select(*key).distinct(), "copies"
    )
    repeated = staged(groups.groupBy(*key).count().where("count > 1").select(*key), "repeated")
    kept = join_small(keyed, copies, key, "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    single = join_small(kept, repeated, key, "left_anti")
    # of rows equal in id and text the first by their other columns, as JSON, stays
    order = F.to_json(F.struct(*docs.columns))
    rows = join_small(kept, repeated, key, "left_semi").groupBy("doc_id", "text").agg(
        F.min_by(F.struct(*docs.columns), order).alias("first")
    )
    once = rows.select("first.*")
    return single.select(*docs.columns).union(once)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and ``n_chars`` set anew where it was."""
    before, text = fresh("_before", docs.columns), fresh("_text", docs.columns)
    masked = secrets.redact_secrets(
        docs.withColumnRenamed("n_chars", before).withColumn(text, F.col("text"))
    )
    changed = ~F.col("text").eqNullSafe(F.col(text))
    return masked.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col(before))
    ).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences; ``ids`` is four-byte little-endian integers."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, vocabulary).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("secret_scans", secrets_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The log-likelihood ratio and the tokenizer have no SQL form; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
