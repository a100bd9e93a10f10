"""Mixing sources to target weights by repetition rates.

Sizes are summed per source, each source gets a target share, and its repetition rate is
target / size. A document is emitted floor(rate) times, plus once more if its hash-seeded
uniform number is below the fraction of the rate. Everything is built-in functions.

Only (source, size) sums and (id, text hash) counts are shuffled, with map-side partial
sums, so a hot source is a few rows per task. The per-source table holds one row per
source; it is stored, counted and broadcast only below a row limit (``common.join_small``).
Documents are never shuffled when it is, but for those that occur more than once.

Defined cases: null text has size 0; the null source is a source of its own, last in
order; empty tables give empty results. The random number depends on seed, document id,
text, and the row's number among the rows that share both. So reruns agree in what is
taken, and of repeated rows each has its own draw; which of two such rows, if they differ
in other columns, gets a copy depends on the order in which they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotcast.llm.common import WORD, fresh, join_small, staged

#: No source is repeated more often than this.
MAX_RATE = 3
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, per name in ``sums``, the total of the rows before theirs in ``order``.

    Rows are sorted by range; each partition sums its own and adds the totals of the
    partitions before it. ``order`` must tell any two rows apart.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(
        rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "mix-ranges"
    )
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    whole = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = whole.select(
        "_part", *[F.coalesce(F.sum(f"_{n}").over(ahead), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()])
    joined = local.join(F.broadcast(offsets), "_part")
    return joined.select(*rows.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Weights repeat over the sources in code point order, null last. Targets share the sum
    of all sizes by weight and stop at ``max_rate`` times the source's size; the excess is
    reshared by weight. That is target = min(cap, weight x level) with one common level:
    in ascending order of cap / weight, the first source that its level does not overfill
    fixes the level; it is the highest such level, since later ones only fall. Sources are
    ranked by range, so any number of them passes through no single task.
    """
    totals = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    by_name = F.col("source").asc_nulls_last()
    turn = F.pmod(F.col("_rank"), F.lit(len(weights)))
    weighed = running(totals, [by_name], {"_rank": F.lit(1)}).select(
        "source",
        "source_size",
        F.get(F.array(*map(F.lit, weights)), turn.cast("int")).alias("_weight"),
    ).withColumn("_cap", F.col("source_size") * max_rate)
    filled = running(
        weighed,
        [(F.col("_cap") / F.col("_weight")).asc(), by_name],
        {"_filled": F.col("_cap"), "_passed": F.col("_weight")},
    )
    every = weighed.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    level = (F.lit(every.size or 0) - F.col("_filled")) / (F.lit(every.weight or 0) - F.col("_passed"))
    leveled = staged(filled.withColumn("_level", level), "mix-levels")
    holds = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))
    common = leveled.agg(F.coalesce(F.max(holds), F.max("_level"))).first()[0]
    share = F.lit(common).cast("double") * F.col("_weight")
    return leveled.select(
        "source", "source_size", F.least(share, F.col("_cap").cast("double")).alias("target")
    )


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``: 1, 2, ... over the rows that share id and text.

    Only ids and text hashes are aggregated to find them. Rows that occur more than once
    are numbered inside their input partitions, and the counts of the partitions before are
    added, so even a third of all rows being one is no single task.
    """
    digest, part = fresh("_digest", docs.columns), fresh("_partition", docs.columns)
    marked = docs.withColumn(digest, F.md5(F.coalesce("text", F.lit(""))))
    key = ["doc_id", digest]
    repeated = staged(marked.groupBy(*key).count().where("count > 1").select(*key), "mix-repeated")
    if repeated.isEmpty():
        return docs.withColumn(name, F.lit(1).cast("long"))
    single = join_small(marked, repeated, key, "left_anti").withColumn(name, F.lit(1).cast("long"))
    again = staged(
        join_small(marked, repeated, key, "left_semi").withColumn(part, F.spark_partition_id()), "mix-again"
    )
    here = W.partitionBy(*key, part)
    counts = again.groupBy(*key, part).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*key).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = staged(
        counts.select(*key, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "mix-offsets"
    )
    local = again.withColumn(name, F.row_number().over(here.orderBy(F.lit(0))).cast("long"))
    base = fresh("_before", local.columns)
    rest = join_small(local, offsets.withColumnRenamed("_before", base), [*key, part]).withColumn(
        name, F.col(name) + F.col(base)
    )
    return single.select(*docs.columns, name).union(rest.select(*docs.columns, name))


def uniform(seed: int, *key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of the key."""
    parts = [F.coalesce(k.cast("string"), F.lit("~")) for k in key]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def mixing_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``.

    The added columns replace columns of ``docs`` of the same name.
    """
    added = ("size", "source_size", "target", "rate", "copies")
    docs = docs.drop(*added)
    sized = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = staged(source_targets(sized, weights, max_rate), "mix-targets")
    mark = fresh("_fraction", docs.columns)
    nth = fresh("_nth", docs.columns)
    docs = numbered(docs, nth)
    planned = (
        join_small(docs.withColumn("size", word_count(F.col("text"))), targets, ["source"])
        .withColumn(
            "rate",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
        )
        .withColumn(mark, F.col("rate") - F.floor("rate"))
    )
    drawn = uniform(seed, F.col("doc_id"), F.md5(F.coalesce("text", F.lit(""))), F.col(nth))
    extra = (drawn < F.col(mark)).cast("long")
    return planned.withColumn("copies", F.floor("rate") + extra).drop(mark, nth)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan says."""
    each = fresh("_copy", docs.columns)
    return (
        mixing_plan(docs, **options)
        .withColumn(each, F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))))
        .where("copies > 0")
        .select(*docs.columns)
    )
