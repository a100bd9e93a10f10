"""The scheduled jobs: train, forecast, score, compare revisions.

Each step that several later steps read is written as a table first: snapshots under
the store's root, intermediate tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.functions.masks import LOAD_FLOOR, WARM_LOAD_FLOOR
from slotcast.operators.blocks import KEYS
from slotcast.operators.grid import fixed_grid
from slotcast.schema import ACCURACY, DEVIATION, FORECAST, FORECAST_LATEST
from slotcast.session import job_stages, staged
from slotcast.sinks import commits
from slotcast.sinks import tables as sinks
from slotcast.sinks.ordered import export_ordered
from slotcast.sources.tables import RETENTION_DAYS, history_first, marker, since

from . import accuracy, boosting, deviation, features, load, matrix, publish, weather

# First slot of the training grid, first training origin, days of grid ahead.
TRAINING_START = "2011-04-01 00:00:00"
FIRST_ORIGIN = "2017-01-01 00:00:00"
DAYS_AHEAD = 3


FORECASTS, LATEST, SCORES, CHANGES = "forecasts", "forecasts_latest", "accuracy", "deviations"


class Store(NamedTuple):
    """Folders of the stored tables below one root."""

    root: str

    @property
    def load(self) -> str:
        return f"{self.root}/load"

    @property
    def weather(self) -> str:
        return f"{self.root}/weather"

    @property
    def markers(self) -> str:
        return f"{self.root}/markers"

    @property
    def models(self) -> str:
        return f"{self.root}/models"

    @property
    def tables(self) -> str:
        """Forecasts, scores and changes, which change together through one log."""
        return f"{self.root}/tables"


def _midnight(as_of: str, days: int = 0) -> str:
    day = datetime.fromisoformat(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return str(day + timedelta(days=days))


def train_job(
    history: DataFrame,
    fresh: DataFrame,
    weather_history: DataFrame,
    weather_feeds: Sequence[DataFrame],
    holidays: DataFrame,
    store: Store,
    as_of: str,
    horizons: Sequence[int] = matrix.HORIZONS,
    start: str = TRAINING_START,
    first_origin: str = FIRST_ORIGIN,
    floor: float = LOAD_FLOOR,
    warm_floor: float = WARM_LOAD_FLOOR,
    rounds: int | None = None,
    growth: Sequence[boosting.Growth] = boosting.GROWTH,
    by: Sequence[str] = KEYS,
) -> str:
    """Refresh the snapshots, build the training matrix, grow and store the models.

    Every series has models of its own, or every value of the columns ``by``. The models
    are one table, a row per series and horizon; its folder is returned. A job can be
    repeated on the same day: it replaces that day's snapshots and models as a whole.
    """
    version = _midnight(as_of)[:10]
    with job_stages(history.sparkSession):
        merged = staged(load.refreshed_history(history, fresh, as_of), "load")
        cleaned = load.training_load(merged, holidays, floor, warm_floor)
        grid = fixed_grid(merged, start, _midnight(as_of, DAYS_AHEAD))
        gridded = staged(load.on_grid(cleaned, grid), "grid")

        recent = weather.training_weather_table(*weather_feeds)
        climate = staged(history_first(weather_history, recent), "weather")
        sinks.write_snapshot(load.snapshot(merged, as_of), store.load, version, replace=True)
        sinks.write_snapshot(load.snapshot(climate, as_of), store.weather, version, replace=True)

        frame = staged(since(features.feature_frame(gridded, climate), first_origin), "features")
        rows = matrix.horizon_matrix(frame, horizons, before=_midnight(as_of))
        grown = boosting.train(staged(rows, "matrix"), by, growth, rounds)
        return sinks.write_snapshot(grown, store.models, version, replace=True)


def forecast_job(
    feeds: Sequence[DataFrame],
    weather_feeds: Sequence[DataFrame],
    processed: DataFrame,
    store: Store,
    as_of: str,
    start: str,
    horizons: Sequence[int] = matrix.HORIZONS,
    floor: float = LOAD_FLOOR,
    warm_floor: float = WARM_LOAD_FLOOR,
    weather_history: DataFrame | None = None,
    source: str = "load",
    history: DataFrame | None = None,
    by: Sequence[str] = KEYS,
) -> DataFrame | None:
    """Forecast the series that have new data; None when no series has.

    ``weather_feeds`` are observed, corrected and forecast weather, in this order. With a
    stored ``history`` (``sinks.newest_snapshot``), the first feed need only hold the last
    days; they are read again into the history. A repeated job stores each record once.
    """
    if history is not None:
        feeds = [load.refreshed_history(history, feeds[0], as_of), *feeds[1:]]
    cleaned = load.clean_load(feeds, as_of, floor, warm_floor)
    fresh = staged(publish.gated(cleaned, processed), "load")
    if fresh.isEmpty():
        return None
    grid = fixed_grid(fresh, start, _midnight(as_of, DAYS_AHEAD))
    gridded = staged(load.on_grid(fresh, grid), "grid")
    climate = weather.optimised_weather_table(*weather_feeds)
    if weather_history is not None:
        climate = history_first(weather_history, climate)
    served = climate.join(fresh.select("series_id").distinct(), "series_id", "left_semi")
    frame = staged(features.feature_frame(gridded, staged(served, "weather")), "features")

    recent = matrix.horizon_matrix(
        frame, horizons, with_target=False, after=_midnight(as_of, -1)
    )
    newest = publish.newest_origins(recent, as_of)
    created = str(datetime.fromisoformat(as_of) + timedelta(minutes=1))
    stored = sinks.newest_snapshot(frame.sparkSession, store.models)
    predictions = boosting.forecast(newest, stored, by).select(*KEYS, "datetime", "horizon", "forecast")
    records = staged(publish.forecast_records(predictions, created), "records")

    latest = staged(publish.latest_records(records), "latest")

    def publish_both(transaction: commits.Transaction) -> None:
        commits.insert_ignore(transaction, FORECASTS, records, sinks.REVISION_KEY)
        commits.upsert(transaction, LATEST, latest)

    commits.attempt(records.sparkSession, store.tables, publish_both)
    stamp = created.replace(" ", "T").replace(":", "")
    export_ordered(latest, f"{store.root}/export/csv/{stamp}", [*KEYS, "date", "start_time", "horizon"])
    sinks.export_json(publish.payload_json(records, source), f"{store.root}/export/json/{stamp}")
    sinks.write_marker(marker(fresh), store.markers, stamp)
    return records


def accuracy_job(
    demand: DataFrame, store: Store, as_of: str, options: Mapping[str, object] | None = None
) -> None:
    """Score the newest closed slots; slots scored before keep their first result."""
    spark = demand.sparkSession
    stored = commits.read(spark, store.tables, FORECASTS, FORECAST)
    with job_stages(spark):
        scored = staged(accuracy.forecast_accuracy(demand, stored, as_of, **(options or {})), "scored")
        commits.attempt(spark, store.tables, lambda t: commits.insert_ignore(t, SCORES, scored))


def deviation_job(spark: SparkSession, store: Store, as_of: str | None = None) -> None:
    """Compare the two newest revisions of each series and append the result."""
    stored = commits.read(spark, store.tables, FORECASTS, FORECAST)
    changes = deviation.revision_deviation(stored, as_of)
    commits.attempt(spark, store.tables, lambda t: t.append(CHANGES, changes))


def upkeep_job(spark: SparkSession, store: Store, as_of: str, days: int = RETENTION_DAYS, keep: int = 10) -> None:
    """Drop the days past retention, merge small folders, and delete what no reader needs."""
    first = _midnight(as_of, -days)[:10]
    for table, schema in ((FORECASTS, FORECAST), (LATEST, FORECAST_LATEST), (SCORES, ACCURACY), (CHANGES, DEVIATION)):
        commits.expire(spark, store.tables, table, first)
        commits.compact(spark, store.tables, table, schema)
    commits.clean(spark, store.tables, keep)


def stored_marker(spark: SparkSession, store: Store) -> DataFrame:
    """Newest processed slot of each series over all runs; empty before the first run."""
    try:
        rows = spark.read.parquet(store.markers)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "series_id string, datetime timestamp_ntz")
    return rows.groupBy("series_id").agg(F.max("datetime").alias("datetime"))
