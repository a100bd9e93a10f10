"""Domain views derived from the stored ``events`` and ``orders`` tables.

A series is a group of 25 users, so series grow in number with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.functions.calendar import add_minutes, clock, ntz, time_block
from slotcast.operators.blocks import KEYS, all_partitions, block_rows
from slotcast.operators.dedup import SLOT_KEYS
from slotcast.operators.grid import densify, fixed_grid, slot_mean, slot_start
from slotcast.operators.interpolate import interpolate_time
from slotcast.operators.windows import DAY_BEFORE_LAGS, seasonal_lag_mean
from slotcast.schema import WEATHER_COLUMNS

FIRST_SLOT = "2024-01-01 00:00:00"
LAST_SLOT = "2024-01-30 23:45:00"
AS_OF = "2024-01-30 00:00:00"
SCORED_AT = "2024-01-30 12:00:00"
ACTUAL_UNTIL = "2024-01-20 00:00:00"
FORECAST_FROM = "2024-01-25 00:00:00"
HOLIDAYS = ("2024-01-01", "2024-01-15", "2024-01-26")
LOAD_FLOOR = 5.0
PRICE_FLOOR, WARM_PRICE_FLOOR = 42_000.0, 100_000.0
SCORED_HORIZONS = (4, 8, 24, 32, 48, 60)
REVISION_HORIZONS = range(4, 161)
SLOTS_A_DAY = 96
FEEDS = ("primary", "feed5", "feed1")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    series = F.concat(F.lit("s"), F.floor(F.col("user_id") / 25).cast("string"))
    return events.select(
        series.alias("series_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("value").alias("mw"),
        F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("source"),
        "event_type",
    )


def load_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.element_at(F.array(*[F.lit(f) for f in FEEDS]), F.col("source") + 1)
    return _events(spark, sf_dir).select(*KEYS, "ts", "mw", names.alias("feed"))


def slot_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean load of the slots that have readings."""
    return slot_mean(load_obs(spark, sf_dir))


def load_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slot of the month; empty slots are null."""
    loads = slot_loads(spark, sf_dir)
    # Asking for a known load makes the series list share the aggregate's shuffle
    # with the loads, instead of scanning the readings again for it.
    series = loads.filter(F.col("block_load").isNotNull())
    return densify(loads, fixed_grid(series, FIRST_SLOT, LAST_SLOT))


def load_feed_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_mean(load_obs(spark, sf_dir), keys=(*KEYS, "feed"))


def load_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolate_time(load_slot(spark, sf_dir), ["block_load"])


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in the layout of the measured-demand table."""
    return load_obs(spark, sf_dir).select(
        *KEYS,
        F.to_date("ts").alias("date"),
        F.substring(F.col("ts").cast("string"), 12, 15).alias("timeslot"),
        F.col("mw").alias("actual_demand_met_mw"),
    )


def weather_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather of three feeds: 0 observed, 1 corrected, 2 forecast."""

    def mean_without(kind: str):
        return F.avg(F.when(F.col("event_type") != kind, F.col("mw")))

    hourly = (
        _events(spark, sf_dir)
        .select("*", slot_start(F.col("ts"), 60).alias("datetime"), F.col("source").alias("feed"))
        .groupBy(*KEYS, "feed", "datetime")
        .agg(
            mean_without("view").alias("apparent_temperature"),
            (mean_without("click") * 0.3).alias("dew_point"),
            (mean_without("purchase") / 200).alias("humidity"),
            mean_without("error").alias("temperature"),
            (F.avg("mw") / 500).alias("cloud_cover"),
            F.max("mw").alias("wind_bearing"),
            (mean_without("signup") / 10).alias("wind_speed"),
        )
        .select(*KEYS, "feed", "datetime", *WEATHER_COLUMNS)
    )
    published = (
        ((F.col("feed") == 0) & (F.col("datetime") < ntz(ACTUAL_UNTIL)))
        | (F.col("feed") == 1)
        | ((F.col("feed") == 2) & (F.col("datetime") >= ntz(FORECAST_FROM)))
    )
    return hourly.filter(published)


def weather_of(spark: SparkSession, sf_dir: str, feed: int) -> DataFrame:
    return weather_feed(spark, sf_dir).filter(F.col("feed") == feed).drop("feed")


def holiday(spark: SparkSession) -> DataFrame:
    """The caller's holiday table."""
    dates = spark.createDataFrame([(d,) for d in HOLIDAYS], "date string")
    return dates.select(F.col("date").cast("date").alias("date"))


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.col("o_orderkey"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("datetime"),
        F.col("o_totalprice").cast("double").alias("block_load"),
    )


def _stored(targets: DataFrame, value) -> DataFrame:
    """Forecast rows as stored: one row per target and horizon."""
    origin = add_minutes(F.col("datetime"), F.col("horizon") * -15)
    return targets.select(
        *KEYS,
        F.to_date("datetime").alias("date"),
        clock(F.col("datetime")).alias("start_time"),
        clock(add_minutes(F.col("datetime"), 15)).alias("end_time"),
        value.alias("forecast"),
        "horizon",
        F.lit("v9").alias("version"),
        add_minutes(origin, 1).alias("created_at"),
        time_block(origin).alias("revision_no"),
    ).filter(F.col("forecast").isNotNull())


def forecast_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal baseline forecasts of every target slot at the scored horizons."""
    targets = seasonal_lag_mean(load_filled(spark, sf_dir))
    steps = F.array(*[F.lit(h) for h in SCORED_HORIZONS])
    return _stored(targets.select("*", F.explode(steps).alias("horizon")), F.col("load_stb"))


def forecast_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions that differ: the baseline plus terms of horizon and origin load."""

    filled = load_filled(spark, sf_dir)
    target = F.col("datetime")
    # What only depends on the target is made once, before its 157 horizons.
    slots = filled.select(
        *SLOT_KEYS,
        "block_load",
        F.to_date(target).alias("date"),
        clock(target).alias("start_time"),
        clock(add_minutes(target, 15)).alias("end_time"),
        time_block(target).alias("tb"),
        add_minutes(target, 1).alias("made"),
    )
    kept = ["datetime", "block_load", "date", "start_time", "end_time", "tb", "made"]
    reach = max(*DAY_BEFORE_LAGS, *REVISION_HORIZONS)
    blocks = block_rows(slots, kept, back=reach, partitions=all_partitions(filled))
    looked_up = {"_idxs": "_idx", "_loads": "block_load", "_mades": "made"}
    arrays = blocks.selectExpr(*KEYS, "_rows", *[f"_rows.{c} as {name}" for name, c in looked_up.items()])
    each = arrays.selectExpr(*KEYS, *looked_up, "posexplode(_rows) as (_at, _row)").filter("_row._own")
    a, b, c = [f"get(_loads, _at - {lag})" for lag in DAY_BEFORE_LAGS]
    targets = each.selectExpr(
        *KEYS, *looked_up, "_at", "_row._idx",
        *[f"_row.{name}" for name in kept if name not in ("block_load", "made")],
        f"({b} + {c} + {a}) / 3 as load_stb",
    ).filter("load_stb is not null")
    back = ", ".join(
        f"struct({h} as horizon, interval '{h * 15 - 1}' minute as _since)" for h in REVISION_HORIZONS
    )
    # Subtracting an interval costs more than all the rest of a row, so an origin's time is
    # looked up like its load; only where rows are missing between the two is it reckoned.
    created = "if(get(_idxs, _at - horizon) = _idx - horizon, get(_mades, _at - horizon), datetime - _since)"
    forecasts = targets.selectExpr("*", f"inline(array({back}))").selectExpr(
        *KEYS,
        "date",
        "start_time",
        "end_time",
        "load_stb + horizon * 0.5D + get(_loads, _at - horizon) * 0.1D as forecast",
        "horizon",
        "'v9' as version",
        f"{created} as created_at",
        f"cast(pmod(tb - 1 - horizon, {SLOTS_A_DAY}) + 1 as int) as revision_no",
    )
    return forecasts.filter("forecast is not null")
