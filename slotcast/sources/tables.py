"""Scans. Every filter is a range or an equality on a raw column, so it reaches the files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.functions.calendar import at, midnight, ntz
from slotcast.operators.blocks import KEYS
from slotcast.operators.dedup import SLOT_KEYS, first_per_key
from slotcast.schema import WEATHER_COLUMNS, conform

REFRESH_DAYS = 7
RETENTION_DAYS = 360


def read_table(
    spark: SparkSession,
    source: str | Mapping[str, str],
    schema: T.StructType | None = None,
    format: str = "parquet",
) -> DataFrame:
    """A stored table: a path, or the options of another reader such as ``jdbc``.

    For ``jdbc`` pass ``partitionColumn`` and its bounds, else one task reads it all.
    """
    if isinstance(source, str):
        df = spark.read.format(format).load(source)
    else:
        df = spark.read.format(format).options(**source).load()
    return conform(df, schema) if schema else df


def days_before(as_of: str, days: int) -> Column:
    return ntz(as_of) - F.make_dt_interval(F.lit(days))


def actual_weather(table: DataFrame, since: str, series: str | None = None) -> DataFrame:
    """Observed weather of one plant (or all) from ``since`` on."""
    return _weather(table, since, series)


def forecast_weather(table: DataFrame, since: str, series: str | None = None) -> DataFrame:
    """Forecast weather from ``since`` on; the table is the caller's choice."""
    return _weather(table, since, series)


def optimised_weather(table: DataFrame, since: str, series: str | None = None) -> DataFrame:
    """Corrected forecast; rows with any unknown value are dropped."""
    return _weather(table, since, series).dropna("any")


def _weather(table: DataFrame, since: str, series: str | None) -> DataFrame:
    rows = table.filter(F.col("datetime") >= ntz(since))
    if series is not None:
        rows = rows.filter(F.col("series_id") == series)
    return rows.select(*SLOT_KEYS, *WEATHER_COLUMNS)


def forecast_rows(table: DataFrame, first: str, last: str, version: str) -> DataFrame:
    """Published forecasts of a version between two target dates, both included."""
    dates = F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return table.filter(dates & (F.col("version") == version))


def demand_rows(
    table: DataFrame, first: str, last: str, series: str | None = None
) -> DataFrame:
    """Measured demand between two dates as ``datetime``/``mw`` readings."""
    rows = table.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if series is not None:
        rows = rows.filter(F.col("series_id") == series)
    return rows.select(
        *KEYS, at(F.col("date"), F.col("timeslot")).alias("ts"), F.col("actual_demand_met_mw").alias("mw")
    )


def revision_rows(table: DataFrame, revisions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows that belong to one of the given revisions."""
    return table.join(revisions.select(*keys, "created_at"), [*keys, "created_at"], "left_semi")


def retained(df: DataFrame, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of the last ``days`` days, from midnight."""
    return df.filter(F.col("datetime") >= midnight(days_before(as_of, days)))


def since(df: DataFrame, start: str) -> DataFrame:
    return df.filter(F.col("datetime") >= ntz(start))


def refresh_window(df: DataFrame, as_of: str, days: int = REFRESH_DAYS) -> DataFrame:
    """The days that every run reads again, so that late readings are picked up."""
    return df.filter(F.col("datetime") >= midnight(ntz(as_of)) - F.make_dt_interval(F.lit(days)))


def closed_days(df: DataFrame, as_of: str) -> DataFrame:
    """Rows before today; only these go into a snapshot."""
    return df.filter(F.col("datetime") < midnight(ntz(as_of)))


def marker(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Newest known slot per series."""
    known = df.filter(F.col("block_load").isNotNull())
    return known.groupBy(*keys).agg(F.max("datetime").alias("datetime"))


def history_first(history: DataFrame, refreshed: DataFrame, keys: Sequence[str] = SLOT_KEYS) -> DataFrame:
    """Keep the stored row of a slot and add slots the history lacks."""
    both = history.withColumn("_new", F.lit(0)).unionByName(refreshed.withColumn("_new", F.lit(1)))
    return first_per_key(both, keys, ["_new"]).drop("_new")
