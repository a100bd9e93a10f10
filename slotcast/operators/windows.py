"""Lags, leads, ramps, rolling means and short fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from slotcast.functions.calendar import SLOT_MINUTES

from .blocks import (
    BLOCK_SLOTS,
    KEYS,
    all_partitions,
    block_of,
    halo_columns,
    in_block,
    row_index,
)

RAMPS = 4
# Lags around the same time of the previous day.
DAY_BEFORE_LAGS = (95, 96, 97)


def shift(w: WindowSpec, column: str, k: int) -> Column:
    """Value ``k`` rows earlier; negative ``k`` looks ahead."""
    return F.lag(column, k).over(w) if k >= 0 else F.lead(column, -k).over(w)


def shifted(
    df: DataFrame, specs: dict[str, tuple[str, int]], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add ``{name: (column, k)}`` shifts on a dense grid."""
    reach = [k for _, k in specs.values()]
    return halo_columns(
        df,
        lambda w: {name: shift(w, c, k) for name, (c, k) in specs.items()},
        keys,
        back=max(0, *reach),
        ahead=max(0, *[-k for k in reach]),
    )


def ramp_columns(w: WindowSpec, column: str = "block_load", count: int = RAMPS) -> dict[str, Column]:
    """Change over each of the last ``count`` steps."""
    values = [F.col(column)] + [shift(w, column, k) for k in range(1, count + 1)]
    return {f"ramp{k}": values[k - 1] - values[k] for k in range(1, count + 1)}


def ramps(df: DataFrame, column: str = "block_load", keys: Sequence[str] = KEYS) -> DataFrame:
    return halo_columns(df, lambda w: ramp_columns(w, column), keys, back=RAMPS)


def day_before_mean(w: WindowSpec, column: str = "block_load") -> Column:
    """Mean of three slots around the same time yesterday; null if one is missing."""
    a, b, c = [shift(w, column, k) for k in DAY_BEFORE_LAGS]
    return (b + c + a) / 3


def seasonal_lag_mean(
    df: DataFrame, column: str = "block_load", keys: Sequence[str] = KEYS
) -> DataFrame:
    return halo_columns(
        df, lambda w: {"load_stb": day_before_mean(w, column)}, keys, back=max(DAY_BEFORE_LAGS)
    )


def full_window_mean(w: WindowSpec, column: str, n: int) -> Column:
    """Mean of the last ``n`` rows, null unless all of them are known."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(column).over(frame) == n, F.avg(column).over(frame))


def rolling_means(
    df: DataFrame,
    specs: dict[str, tuple[str, int]],
    keys: Sequence[str],
    order: Sequence[str] = ("datetime",),
    length: int = BLOCK_SLOTS,
) -> DataFrame:
    """Add ``{name: (column, n)}`` rolling means over rows, gaps or not.

    Rows get an exact number per key, and blocks of that number overlap by the
    longest window.
    """
    reach = max(n for _, n in specs.values()) - 1
    numbered = row_index(df, keys, order)
    home = block_of(F.col("_row"), length)
    served = F.sequence(home, block_of(F.col("_row") + reach, length))
    # Work per row grows with the window, not with its bytes: keep all partitions.
    blocked = numbered.select("*", F.explode(served).alias("_blk")).repartition(
        all_partitions(df), *keys, "_blk"
    )
    w = in_block(keys, ["_row"])
    widened = blocked.select(
        "*", *[full_window_mean(w, c, n).alias(name) for name, (c, n) in specs.items()]
    )
    return widened.filter(F.col("_blk") == home).drop("_blk", "_row")


def fill_columns(w: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    """One step forward, then one step backward."""
    return {c: F.coalesce(F.col(c), shift(w, c, 1), shift(w, c, -1)) for c in columns}


def limited_fill(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """Fill each null from its neighbours, at most one step, forward before backward."""
    names = {f"_filled_{c}": c for c in columns}
    filled = halo_columns(
        df,
        lambda w: {f"_filled_{c}": v for c, v in fill_columns(w, columns).items()},
        keys,
        back=1,
        ahead=1,
        minutes=minutes,
    )
    return filled.drop(*columns).withColumnsRenamed(names).select(*df.columns)


def hour_means(
    df: DataFrame,
    column: str = "block_load",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Mean per date and hour (1 to 24)."""
    return df.groupBy(*keys, "date", "hour").agg(F.avg(column).alias("hour_mean"))


def attach_hour_mean(
    df: DataFrame, column: str = "block_load", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Left join of the hourly mean to each slot."""
    return df.join(hour_means(df, column, keys), [*keys, "date", "hour"], "left")
