"""Regular grids and resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.functions.calendar import SLOT_MINUTES, add_minutes, midnight, ntz

from .blocks import KEYS, all_partitions, slot_index

DAY = 24 * 60


def slot_start(ts: Column, minutes: int = SLOT_MINUTES) -> Column:
    return F.window(ts, f"{minutes} minutes").start


def slot_mean(
    readings: DataFrame,
    value: str = "mw",
    ts: str = "ts",
    keys: Sequence[str] = KEYS,
    minutes: int = SLOT_MINUTES,
    name: str = "block_load",
) -> DataFrame:
    """Mean per slot; partial sums are built before the shuffle, so a hot slot is cheap."""
    # Grouping by the start itself, not the window struct, lets a join on it reuse the shuffle.
    slots = readings.select(*keys, slot_start(F.col(ts), minutes).alias("datetime"), value)
    return slots.groupBy(*keys, "datetime").agg(F.avg(value).alias(name))


def spread(bounds: DataFrame, keys: Sequence[str] = KEYS, minutes: int = SLOT_MINUTES) -> DataFrame:
    """One row per slot from ``_first`` to ``_last`` (both slot starts, included).

    Days first, slots second: no array grows with the length of the series. The list of
    series is small in bytes whatever it expands to, so it is dealt to all partitions first;
    by a hash, because a placement by the keys themselves would be dropped as the one that
    the list already has, and then merged by size.
    """
    dealt = bounds.repartition(all_partitions(bounds), F.xxhash64(*keys))
    days = dealt.select(
        *keys,
        "_first",
        "_last",
        F.explode(
            F.sequence(
                midnight(F.col("_first")),
                midnight(F.col("_last")),
                F.expr("interval 1 day"),
            )
        ).alias("_day"),
    )
    slots = F.sequence(
        F.col("_day"),
        add_minutes(F.col("_day"), DAY - minutes),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0)),
    )
    return (
        days.select(*keys, "_first", "_last", F.explode(slots).alias("datetime"))
        .filter(F.col("datetime").between(F.col("_first"), F.col("_last")))
        .select(*keys, "datetime")
    )


def fixed_grid(
    series: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = KEYS,
    minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """The same range of slots, both ends included, for every series of ``series``."""
    bounds = (
        series.select(*keys)
        .distinct()
        .select(*keys, ntz(start).alias("_first"), ntz(end).alias("_last"))
    )
    return spread(bounds, keys, minutes)


def own_grid(
    df: DataFrame, keys: Sequence[str] = KEYS, ts: str = "datetime", minutes: int = SLOT_MINUTES
) -> DataFrame:
    """Slots from the first to the last row of each series."""

    def floored(end: Column) -> Column:
        return add_minutes(ntz("1970-01-01 00:00:00"), slot_index(end, minutes) * minutes)

    bounds = df.groupBy(*keys).agg(
        floored(F.min(ts)).alias("_first"), floored(F.max(ts)).alias("_last")
    )
    return spread(bounds, keys, minutes)


def densify(df: DataFrame, grid: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Full outer join with the grid: empty slots appear, rows off the grid stay."""
    return df.join(grid, [*keys, "datetime"], "full")


def resample_mean(
    readings: DataFrame,
    value: str = "mw",
    ts: str = "ts",
    keys: Sequence[str] = KEYS,
    minutes: int = SLOT_MINUTES,
    name: str = "block_load",
) -> DataFrame:
    """Tumbling mean; empty slots between the first and the last reading are null."""
    means = slot_mean(readings, value, ts, keys, minutes, name)
    grid = own_grid(means, keys, minutes=minutes)
    return grid.join(means.hint("merge"), [*keys, "datetime"], "left")


def as_frequency(
    df: DataFrame, keys: Sequence[str] = KEYS, minutes: int = SLOT_MINUTES
) -> DataFrame:
    """Resample without aggregation: rows off the grid vanish, empty slots are null.

    The input must be unique per key and time.
    """
    return own_grid(df, keys, minutes=minutes).join(df.hint("merge"), [*keys, "datetime"], "left")
