"""Masks that turn implausible values into null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import WARM_MONTHS, season

# Default floors of the load masks, in MW.
LOAD_FLOOR = 420.0
WARM_LOAD_FLOOR = 1000.0

# Temperature floors and dependent columns of the live and training masks.
LIVE_FLOOR = 2.0
LIVE_DEPENDENTS = ("dew_point", "apparent_temperature", "humidity")
TRAINING_FLOOR = 3.0
TRAINING_DEPENDENTS = LIVE_DEPENDENTS + ("cloud_cover", "wind_bearing", "wind_speed")


def plausible_load(
    load: Column, ts: Column, floor: float = LOAD_FLOOR, warm_floor: float = WARM_LOAD_FLOOR
) -> Column:
    """Apply the floor, and the higher floor inside the warm season.

    The first and the last month of the season are exempt from the higher floor.
    """
    month = F.month(ts)
    deep_season = (season(month) == 2) & ~month.isin(*WARM_MONTHS)
    too_low = (load < floor) | ((load < warm_floor) & deep_season)
    return F.when(too_low, None).otherwise(load)


def cascade_mask(df: DataFrame, floor: float, dependents: Iterable[str]) -> DataFrame:
    """Null a temperature below the floor, then the columns that depend on it."""
    kept = F.coalesce(F.col("temperature") >= floor, F.lit(False))
    names = {"temperature", *dependents}
    return df.select(
        *[F.when(kept, F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns]
    )


def exceeds(value: Column, threshold: float) -> Column:
    """0/1 flag; unknown counts as 0."""
    return F.coalesce(value > threshold, F.lit(False)).cast("int")
