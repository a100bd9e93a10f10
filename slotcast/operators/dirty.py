"""Recomputing only what corrected slots reach.

A result that looks ``back`` slots back and ``ahead`` slots ahead changes with a corrected
slot if it lies between ``ahead`` slots before it and ``back`` slots after it. The blocks of
these results are dirty; they are computed anew from their own rows and the few neighbouring
ones they look at, and replace the stored rows. All other rows are neither read nor written
again, so the work grows with the corrections and not with the history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.calendar import SLOT_MINUTES
from slotcast.session import staged

from .blocks import BLOCK_SLOTS, KEYS, block_of, slot_index


def _blocked(df: DataFrame, ts: str, minutes: int, length: int) -> DataFrame:
    return df.withColumn("_blk", block_of(slot_index(F.col(ts), minutes), length))


def dirty_blocks(
    corrections: DataFrame,
    back: int,
    ahead: int,
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    minutes: int = SLOT_MINUTES,
    length: int = BLOCK_SLOTS,
) -> DataFrame:
    """(keys, _blk) of the blocks with results that one of the corrected slots reaches."""
    at = slot_index(F.col(ts), minutes)
    reached = F.sequence(block_of(at - ahead, length), block_of(at + back, length))
    return corrections.select(*keys, F.explode(reached).alias("_blk")).distinct()


def needed_blocks(
    dirty: DataFrame, back: int, ahead: int, keys: Sequence[str] = KEYS, length: int = BLOCK_SLOTS
) -> DataFrame:
    """(keys, _blk) of the blocks whose rows the dirty blocks' results look at."""
    around = F.sequence(
        F.col("_blk") - F.ceil(F.lit(back) / length).cast("bigint"),
        F.col("_blk") + F.ceil(F.lit(ahead) / length).cast("bigint"),
    )
    return dirty.select(*keys, F.explode(around).alias("_blk")).distinct()


def rebuilt(
    stored: DataFrame,
    rows: DataFrame,
    corrections: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    back: int,
    ahead: int = 0,
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    minutes: int = SLOT_MINUTES,
    length: int = BLOCK_SLOTS,
) -> DataFrame:
    """``stored`` with the results of dirty blocks as ``build`` makes them from ``rows``.

    ``stored`` is what ``build`` made of the rows before the correction, ``rows`` holds them
    corrected, ``corrections`` names the changed slots by ``keys`` and ``ts``. ``build``
    keeps these columns, and its results look no further than ``back`` and ``ahead``.
    """
    dirty = staged(dirty_blocks(corrections, back, ahead, keys, ts, minutes, length), "dirty-blocks")
    on = [*keys, "_blk"]
    needed = needed_blocks(dirty, back, ahead, keys, length)
    read = _blocked(rows, ts, minutes, length).join(needed, on, "left_semi").drop("_blk")
    made = _blocked(build(read), ts, minutes, length).join(dirty, on, "left_semi")
    kept = _blocked(stored, ts, minutes, length).join(dirty, on, "left_anti")
    return kept.select(*stored.columns).union(made.select(*stored.columns))
