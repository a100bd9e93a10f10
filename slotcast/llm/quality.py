"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the corpus.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted, one over every document of the corpus and one
over the documents that the labels trust. A document's score is the mean, over its
n-grams, of the log ratio of the two; documents below a fixed threshold are not kept.
Simple counts of a text (the base rules) go beside it.

All of it is built-in functions. The two multinomials are one aggregation with map-side
partial sums (at most one row per bucket and task leaves a task); their log ratios are
one row of ``buckets`` doubles, which is what scoring broadcasts. The corpus meets the ids
of the trusted documents by a broadcast if their number allows, else by one shuffle, and
is scored without a shuffle.

Defined cases: a null or blank text has no words, fails the base rule and has score 0.
Rows are judged one by one, so repeated rows get equal verdicts. Labels with a null
document id trust nothing; several labels of one document trust it if none of them is
bad. Without any trusted document every score is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotcast.llm.common import WORD, fresh, join_small, staged, words_of

BUCKETS = 1 << 14
SMOOTHING = 0.5
#: Mean log ratio below which a document goes.
THRESHOLD = -0.15
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"


def gram_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and of all pairs of neighbouring words."""
    ones = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(buckets)).cast(
            "int"
        ),
    )
    return F.when(F.size(words) > 1, F.concat(ones, pairs)).otherwise(ones)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents whose labels all say good and none says toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("_good"))
        .where("_good = 1")
    )


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: ``ratios array<double>``, the log ratio of every bucket.

    Counts run over every document; add-``SMOOTHING`` keeps unseen buckets finite.
    """
    known = staged(trusted_ids(labels), "trusted")
    grams = (
        join_small(docs.select("doc_id", "text"), known, ["doc_id"], "left")
        .select(words_of(F.col("text")).alias("_words"), F.coalesce("_good", F.lit(0)).alias("_t"))
        .select(F.explode(gram_buckets(F.col("_words"), buckets)).alias("_b"), "_t")
    )
    counted = grams.groupBy("_b").agg(F.count("*").alias("_raw"), F.sum("_t").alias("_tgt"))
    every, smooth = W.partitionBy(), F.lit(SMOOTHING)

    def log_share(count: str) -> Column:
        total = F.sum(count).over(every) + smooth * buckets
        return F.log((F.coalesce(count, F.lit(0)) + smooth) / total)

    # from here on there are exactly ``buckets`` rows, whatever the corpus
    ratio = F.when(F.sum("_tgt").over(every) > 0, log_share("_tgt") - log_share("_raw"))
    return (
        docs.sparkSession.range(buckets)
        .join(counted, F.col("id") == F.col("_b"), "left")
        .select("id", F.coalesce(ratio, F.lit(0.0)).alias("_ratio"))
        .agg(F.sort_array(F.collect_list(F.struct("id", "_ratio"))).alias("_s"))
        .select(F.col("_s._ratio").alias("ratios"))
    )


def base_rules(docs: DataFrame, words: str) -> DataFrame:
    """The base counts of every row, from its text and its word array ``words``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    w = F.col(words)
    with_word = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    lines, tri, dup = (fresh(x, docs.columns) for x in ("_lines", "_tri", "_dup"))
    triples = F.when(
        F.size(w) > 2,
        F.transform(
            F.sequence(F.lit(2), F.size(w) - 1),
            lambda i: F.xxhash64(F.get(w, i - 2), F.get(w, i - 1), F.get(w, i)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = docs.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            lines: with_word,
            tri: triples,
        }
    )
    # Only texts with a repeated window pay for sorting their windows by hash and place.
    some = F.size(F.array_distinct(tri)) < F.size(tri)
    placed = F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = counted.withColumns(
        {
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            dup: F.when(some, placed),
        }
    )
    twin = F.filter(
        dup,
        lambda x, k: (x["h"] == F.get(dup, k - 1)["h"]) | (x["h"] == F.get(dup, k + 1)["h"]),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(twin, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    )
    repeats = F.when(F.col(dup).isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")
    return counted.withColumn("n_repeat_words", repeats).drop(lines, tri, dup)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All columns of ``docs`` with counts, ``base_failed``, ``score`` and ``kept``.

    The added columns replace columns of ``docs`` of the same name.
    """
    words, one, row, grams = (
        fresh(x, docs.columns) for x in ("_words", "_one", "_row", "_grams")
    )
    ratios = log_ratios(docs, labels, buckets).select(
        (F.size("ratios") > 0).alias(row), F.col("ratios").alias(f"{row}_ratios")
    )
    ruled = base_rules(docs.withColumn(words, words_of(F.col("text"))), words)
    # the other side is one row of ``buckets`` doubles, and every row meets it
    scored = (
        ruled.withColumns({grams: gram_buckets(F.col(words), buckets), one: F.size(words) >= 0})
        .join(F.broadcast(ratios), F.col(one) == F.col(row))
        .withColumn(
            "score",
            F.when(F.size(grams) == 0, F.lit(0.0)).otherwise(
                F.aggregate(grams, F.lit(0.0), lambda s, b: s + F.get(f"{row}_ratios", b))
                / F.size(grams)
            ),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    # A filter on the verdict must not move below the arrays that it is made from: it would
    # compute them anew for every element. The row number, always true here, holds it back.
    fixed = F.monotonically_increasing_id() >= 0
    return (
        scored.withColumns(
            {"base_failed": failed, "kept": ~failed & (F.col("score") >= threshold) & fixed}
        )
        .drop(words, one, row, f"{row}_ratios", grams)
    )
