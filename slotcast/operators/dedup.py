"""Set operations, first-wins rules and top-n per group.

First-wins is an aggregate, not a window: each map task keeps one candidate per key
before the shuffle, so many copies of one key never meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import KEYS

SLOT_KEYS = (*KEYS, "datetime")


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate and drop exact copies; null equals null."""
    for other in others:
        first = first.unionByName(other)
    return first.distinct()


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], last: bool = False
) -> DataFrame:
    """Keep the row that is lowest (``last``: highest) in ``order`` for each key.

    ``order`` should end in a unique column. Nulls in the kept row stay null.
    """
    payload = [c for c in df.columns if c not in keys]
    rank = [c if isinstance(c, Column) else F.col(c) for c in order]
    pick = F.max_by if last else F.min_by
    # One ordering column stays primitive, which keeps the aggregate hash based.
    by = rank[0] if len(rank) == 1 else F.struct(*rank)
    if len(rank) == 1:
        chosen = df.groupBy(*keys).agg(*[pick(c, by).alias(c) for c in payload])
        return chosen.select(*df.columns)
    if all(isinstance(c, str) for c in order) and sorted(order) == sorted(payload):
        # the row is its own order, so that it is not shuffled twice
        least = (F.max if last else F.min)(by).alias("_row")
        chosen = df.groupBy(*keys).agg(least)
        return chosen.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    chosen = df.groupBy(*keys).agg(pick(F.struct(*payload), by).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def priority_union(
    feeds: Sequence[DataFrame],
    keys: Sequence[str] = SLOT_KEYS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Merge feeds; for each key the earliest feed in the list wins, row by row.

    A feed that may repeat a key needs ``tie`` columns to say which copy wins.
    """
    ranked = [feed.withColumn("_prio", F.lit(i)) for i, feed in enumerate(feeds)]
    merged = ranked[0]
    for feed in ranked[1:]:
        merged = merged.unionByName(feed)
    return first_per_key(merged, keys, ["_prio", *tie]).drop("_prio")


def last_rows(
    df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], name: str | None = None
) -> DataFrame:
    """The newest ``n`` rows of each key. Spark trims each map task to n rows per key."""
    number = name or "_newest"
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    kept = df.withColumn(number, F.row_number().over(w)).filter(F.col(number) <= n)
    return kept if name else kept.drop(number)


def _first_hashed(
    df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], number: str
) -> DataFrame:
    """The first ``n`` rows of each key with their number, placed by ``_hash`` and key.

    The key's hash goes first: Spark sorts by the first column's eight bytes, and compares
    whole rows only where these are equal, which keys that begin alike would often be.
    """
    w = Window.partitionBy("_hash", *keys).orderBy(*order)
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    return hashed.withColumn(number, F.row_number().over(w)).filter(F.col(number) <= n)


def first_rows(
    df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], name: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key, trimmed like ``last_rows``."""
    kept = _first_hashed(df, n, keys, order, name or "_place").drop("_hash")
    return kept if name else kept.drop("_place")


def first_rows_packed(
    df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per key: ``_rows``, a struct of arrays with its first ``n`` rows' columns in order.

    Packed where they are ranked, without another shuffle; arrays by column compress best.
    """
    kept = _first_hashed(df, n, keys, order, "_place")
    listed = F.sort_array(F.collect_list(F.struct("_place", *columns)))
    packed = kept.groupBy("_hash", *keys).agg(listed.alias("_listed"))
    return packed.select(*keys, F.struct(*[F.col(f"_listed.{c}").alias(c) for c in columns]).alias("_rows"))


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key."""
    return first_per_key(df, keys, order, last=True)


def newest_values(
    df: DataFrame, column: str, n: int = 2, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The ``n`` highest distinct values per key with their rank, 1 = newest."""
    distinct = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    return last_rows(distinct, n, keys, [column], name="newest")
