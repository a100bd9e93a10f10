"""The feature frame: one row per series and slot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.functions.calendar import calendar_columns
from slotcast.functions.comfort import humidex, relative_humidity
from slotcast.operators.blocks import KEYS, drop_blocks, in_block, with_blocks
from slotcast.operators.ewm import Ewm, block_length, ewm_blocked
from slotcast.operators.windows import (
    DAY_BEFORE_LAGS,
    RAMPS,
    day_before_mean,
    ramp_columns,
    shift,
)
from slotcast.schema import WEATHER_COLUMNS

AHEAD = 4

# Names, sources and spans of the exponentially weighted means.
LOAD_MEANS = [
    Ewm("load_wm2h", "block_load", 8),
    Ewm("load_wm3h", "block_load", 12),
    Ewm("load_wm6h", "block_load", 24),
    Ewm("load_wm12h", "block_load", 48),
]
WEATHER_MEANS = [
    Ewm("temp_mean_3h", "temperature", 12),
    Ewm("temp_mean_6h", "temperature", 24),
    Ewm("temp_mean_9h", "temperature", 36),
    Ewm("temp_mean_12h", "temperature", 48),
    Ewm("aptemp_mean_3h", "apparent_temperature", 12),
    Ewm("aptemp_mean_5h", "apparent_temperature", 20),
    Ewm("aptemp_mean_6h", "apparent_temperature", 24),
    Ewm("aptemp_mean_9h", "apparent_temperature", 36),
    Ewm("aptemp_mean_12h", "apparent_temperature", 48),
    Ewm("apptem_mean_1h_ahead", "_aptemp_ahead", 4),
    Ewm("humidity_mean_1h", "humidity", 4),
    Ewm("wind_speed_5h", "wind_speed", 20),
]
LOAD_FEATURES = [m.name for m in LOAD_MEANS] + [
    *(f"ramp{k}" for k in range(1, RAMPS + 1)),
    "hour_mean",
]


def comfort_columns() -> dict[str, Column]:
    """Indices and interactions of one slot."""
    temperature, felt = F.col("temperature"), F.col("apparent_temperature")
    return {
        "humidex": humidex(temperature, F.col("dew_point")),
        "RH": relative_humidity(F.col("dew_point"), felt),
        "tb_aptemp": F.col("tb") * felt,
        "hour_temp": F.col("hour") * temperature,
    }


def feature_frame(load: DataFrame, weather: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All features of each slot.

    ``load`` is on its grid; weather slots outside that grid are kept with null load
    features. After the join there is one shuffle by (series, block): the lags (with a
    halo), the weighted means, the hour means and the day-before mean all run on it.
    """
    gridded = load.select(*keys, "datetime", "block_load", F.lit(True).alias("_gridded"))
    joined = gridded.join(
        weather.select(*keys, "datetime", *WEATHER_COLUMNS), [*keys, "datetime"], "full"
    )
    calendar = calendar_columns(F.col("datetime"))
    framed = joined.select("*", *[c.alias(name) for name, c in calendar.items()])

    means = [*LOAD_MEANS, *WEATHER_MEANS]
    length = block_length(means)
    blocked = with_blocks(
        framed, length=length, back=max(DAY_BEFORE_LAGS), ahead=AHEAD, keys=keys
    )
    w = in_block(keys)
    lagged = {
        **ramp_columns(w),
        "load_stb": day_before_mean(w),
        "_aptemp_ahead": shift(w, "apparent_temperature", -AHEAD),
    }
    own = blocked.select("*", *[c.alias(name) for name, c in lagged.items()]).filter("_own")
    # A block holds whole days, so the hours of a day never leave it.
    by_hour = Window.partitionBy(*keys, "_blk", "date", "hour")
    averaged = own.withColumn("hour_mean", F.avg("block_load").over(by_hour))
    weighted = ewm_blocked(averaged, means, keys, length)

    on_load_grid = F.coalesce("_gridded", F.lit(False))
    outside = {name: F.when(on_load_grid, F.col(name)) for name in LOAD_FEATURES}
    plain = [c for c in weighted.columns if c not in outside]
    done = weighted.select(
        *plain,
        *[c.alias(name) for name, c in outside.items()],
        *[c.alias(name) for name, c in comfort_columns().items()],
    )
    return drop_blocks(done).drop("_gridded", "_aptemp_ahead")
