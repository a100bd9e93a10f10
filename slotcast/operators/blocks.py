"""Blocks: the unit of work of every window over a series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from slotcast.functions.calendar import SLOT_MINUTES

KEYS = ("series_id",)
# Ten days of 15-minute slots. Blocks start at midnight, so a day never spans two.
BLOCK_SLOTS = 960

HELPERS = ("_idx", "_blk", "_own")


def slot_index(ts: Column, minutes: int = SLOT_MINUTES) -> Column:
    """Number of the slot since 1970-01-01; ``minutes`` divides the day."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    of_day = F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes)
    return days * (1440 // minutes) + of_day


def block_of(index: Column, length: int) -> Column:
    return F.floor(index / length).cast("bigint")


def all_partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, as a number that is not merged by size later.

    For steps whose work per row, or rows per input row, the bytes do not show.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_blocks(
    df: DataFrame,
    ts: str = "datetime",
    minutes: int = SLOT_MINUTES,
    length: int = BLOCK_SLOTS,
    back: int = 0,
    ahead: int = 0,
    keys: Sequence[str] = KEYS,
    shuffle: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``_idx``, ``_blk`` and ``_own`` and place the rows by (keys, block).

    With ``back``/``ahead`` a row is also copied into each neighbouring block that
    holds a row looking up to ``back`` slots back or ``ahead`` slots ahead at it;
    copies have ``_own`` false. The copies are (back + ahead) / length of the rows.

    The placement is explicit so that an operator which reads the frame twice, once
    for its windows and once for its block summaries, runs this one shuffle only.
    """
    # The filter states what the joins on block keys imply; stated here it is the same
    # for every reader of the frame, which keeps their shuffles identical.
    known = " and ".join(f"`{c}` is not null" for c in (*keys, ts))
    indexed = df.filter(known).withColumn("_idx", slot_index(F.col(ts), minutes))
    home = block_of(F.col("_idx"), length)
    if back or ahead:
        first = block_of(F.col("_idx") - ahead, length)
        last = block_of(F.col("_idx") + back, length)
        blocked = indexed.select("*", F.explode(F.sequence(first, last)).alias("_blk"))
    else:
        blocked = indexed.withColumn("_blk", home)
    if shuffle:
        placed = [*keys, "_blk"]
        blocked = (
            blocked.repartition(partitions, *placed) if partitions else blocked.repartition(*placed)
        )
    own = F.col("_blk") == home if back or ahead else F.lit(True)
    return blocked.withColumn("_own", own)


def in_block(keys: Sequence[str] = KEYS, order: Sequence[Column | str] = ("_idx",)) -> WindowSpec:
    return Window.partitionBy(*keys, "_blk").orderBy(*order)


def drop_blocks(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


def halo_columns(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    back: int = 0,
    ahead: int = 0,
    minutes: int = SLOT_MINUTES,
    length: int = BLOCK_SLOTS,
    partitions: int | None = None,
) -> DataFrame:
    """Add window columns that look at most ``back``/``ahead`` slots away.

    Row offsets equal slot offsets, so the input must be dense and unique per slot.
    """
    blocked = with_blocks(df, ts, minutes, length, back, ahead, keys, partitions=partitions)
    added = columns(in_block(keys))
    widened = blocked.select("*", *[c.alias(name) for name, c in added.items()])
    return drop_blocks(widened.filter("_own"))


def block_rows(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    minutes: int = SLOT_MINUTES,
    length: int = BLOCK_SLOTS,
    back: int = 0,
    ahead: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """One row per block: keys and ``_rows``, its rows and halo in order of time.

    For looks at very many distances: a place in the array instead of a window function
    each. A block's rows are bounded by its length and halo. ``_own`` is false for copies.
    """
    blocked = with_blocks(df, ts, minutes, length, back, ahead, keys, partitions=partitions)
    row = F.struct("_idx", "_own", *columns)
    grouped = blocked.groupBy(*keys, "_blk").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return grouped.drop("_blk")


def over(
    keys: Sequence[str], order: str, frame: str = "rows between unbounded preceding and current row"
) -> str:
    """The OVER clause of an SQL window expression."""
    return f"over (partition by {', '.join(keys)} order by {order} {frame})"


def carry_window(keys: Sequence[str] = KEYS, descending: bool = False) -> WindowSpec:
    """All earlier (or later) blocks of a series, one summary row each."""
    order = F.desc("_blk") if descending else F.asc("_blk")
    return (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )


def join_carry(main: DataFrame, carry: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Attach block summaries; both sides are keyed like the block windows."""
    return main.join(carry, [*keys, "_blk"], "left")


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str = "datetime",
    minutes: int = SLOT_MINUTES,
    length: int = BLOCK_SLOTS,
    name: str = "_row",
) -> DataFrame:
    """Consecutive row number per key in time order, without one task per key.

    Rows are numbered inside time blocks; the rows of earlier blocks are added from
    one count per block.
    """
    blocked = with_blocks(df, ts, minutes, length, shuffle=False).drop("_idx", "_own")
    offsets = blocked.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(
        *keys,
        "_blk",
        F.coalesce(F.sum("_n").over(carry_window(keys)), F.lit(0)).alias("_before"),
    )
    local = blocked.withColumn(name, F.row_number().over(in_block(keys, order)))
    joined = join_carry(local, offsets, keys)
    return joined.withColumn(name, F.col(name) + F.col("_before")).drop("_blk", "_before")
