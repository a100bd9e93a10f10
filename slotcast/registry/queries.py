"""Registered queries over the stored tables, ready to compare with the oracles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.functions.calendar import calendar_columns, ntz, season
from slotcast.functions.masks import (
    LIVE_DEPENDENTS,
    LIVE_FLOOR,
    TRAINING_DEPENDENTS,
    TRAINING_FLOOR,
    cascade_mask,
    plausible_load,
)
from slotcast.operators import dirty, windows
from slotcast.operators.blocks import KEYS
from slotcast.operators.dedup import latest_row, priority_union, union_distinct
from slotcast.operators.ewm import ewm_means, ewm_state
from slotcast.operators.fanout import fan_out
from slotcast.operators.grid import fixed_grid, resample_mean
from slotcast.operators.interpolate import interpolate_time, known_points, upsample
from slotcast.plans import accuracy, boosting, deviation, features, load, matrix, models, publish, ridge, weather
from slotcast.schema import WEATHER_COLUMNS
from slotcast.session import delete_paths, release_shuffles, scratch_path, staged, staged_at
from slotcast.sinks import commits, ordered
from slotcast.sinks import tables as sinks
from slotcast.sources import tables
from slotcast.sources import views as v
from slotcast.streaming import ingest, slots

Query = Callable[[SparkSession, str], DataFrame]

CUT = 0.4863
BASELINE_HORIZONS = range(20, 96)
FORECAST_SINCE = "2024-01-27 00:00:00"
SMALL_HORIZONS = (4, 24, 120)

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def comparable(df: DataFrame) -> DataFrame:
    """Cut reals to four digits, off the half-way point where engines may differ."""
    return df.selectExpr(
        *[
            f"floor(`{f.name}` * 10000 + {CUT}D) / 10000 as `{f.name}`"
            if isinstance(f.dataType, T.DoubleType)
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


# --- sources -------------------------------------------------------------------------


@query
def weather_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = [v.weather_of(spark, sf_dir, i) for i in range(3)]
    scans = {
        "actual": tables.actual_weather(feeds[0], v.FIRST_SLOT),
        "optimised": tables.optimised_weather(feeds[1], v.FIRST_SLOT),
        "forecast": tables.forecast_weather(feeds[2], FORECAST_SINCE),
    }
    named = [df.withColumn("source", F.lit(name)) for name, df in scans.items()]
    return comparable(named[0].unionByName(named[1]).unionByName(named[2]))


@query
def demand_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(tables.demand_rows(v.demand(spark, sf_dir), "2024-01-29", "2024-01-30"))


@query
def forecast_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = v.forecast_live(spark, sf_dir)
    return comparable(tables.forecast_rows(stored, "2024-01-29", "2024-01-30", "v9"))


@query
def revision_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = v.forecast_live(spark, sf_dir)
    return comparable(tables.revision_rows(stored, deviation.latest_revisions(stored)))


@query
def retained_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(tables.retained(v.slot_loads(spark, sf_dir), v.AS_OF))


# --- slots, masks, set operations ----------------------------------------------------


@query
def slot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = calendar_columns(F.col("datetime"))
    dense = v.load_slot(spark, sf_dir)
    return comparable(dense.select("*", *[c.alias(n) for n, c in calendar.items()]))


@query
def tumbling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(resample_mean(v.load_obs(spark, sf_dir)))


@query
def load_floor_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("datetime")
    kept = plausible_load(F.col("block_load"), ts, v.PRICE_FLOOR, v.WARM_PRICE_FLOOR)
    return comparable(
        v.price_series(spark, sf_dir).select(
            "o_orderkey",
            "datetime",
            F.month(ts).cast("int").alias("month"),
            season(F.month(ts)).alias("season"),
            kept.alias("block_load"),
        )
    )


@query
def weather_cascade_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = v.weather_feed(spark, sf_dir)
    live = cascade_mask(feed, LIVE_FLOOR, LIVE_DEPENDENTS)
    training = cascade_mask(feed, TRAINING_FLOOR, TRAINING_DEPENDENTS)
    return comparable(
        live.withColumn("variant", F.lit("live")).unionByName(
            training.withColumn("variant", F.lit("training"))
        )
    )


def _feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    slots = v.load_feed_slot(spark, sf_dir)
    return [slots.filter(F.col("feed") == name).drop("feed") for name in v.FEEDS]


@query
def source_priority_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(priority_union(_feeds(spark, sf_dir)))


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = staged(priority_union(_feeds(spark, sf_dir)), "merged-load")
    history = tables.closed_days(merged, v.AS_OF)
    return union_distinct(history, tables.refresh_window(merged, v.AS_OF))


@query
def refreshed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds' history, with the last days read again and corrected by 1."""
    merged = priority_union(_feeds(spark, sf_dir))
    fresh = merged.withColumn("block_load", F.col("block_load") + 1)
    return comparable(load.refreshed_history(tables.closed_days(merged, v.AS_OF), fresh, v.AS_OF))


@query
def union_distinct_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_refreshed(spark, sf_dir))


@query
def history_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(load.snapshot(_refreshed(spark, sf_dir), v.AS_OF))


def _weather_feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    feeds = [v.weather_of(spark, sf_dir, i) for i in range(3)]
    return [
        tables.actual_weather(feeds[0], v.FIRST_SLOT),
        tables.optimised_weather(feeds[1], v.FIRST_SLOT),
        tables.forecast_weather(feeds[2], v.FORECAST_FROM),
    ]


@query
def weather_priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(weather.merge_weather(_weather_feeds(spark, sf_dir)))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = v.slot_loads(spark, sf_dir).filter("block_load is not null")
    return fixed_grid(slots, v.FIRST_SLOT, v.LAST_SLOT)


def _training_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = load.training_load(
        v.slot_loads(spark, sf_dir), v.holiday(spark), v.LOAD_FLOOR, v.LOAD_FLOOR
    )
    return load.on_grid(masked, _grid(spark, sf_dir))


@query
def holiday_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_training_load(spark, sf_dir))


def _clean_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.clean_load(_feeds(spark, sf_dir), v.AS_OF, v.LOAD_FLOOR, v.LOAD_FLOOR)


@query
def clean_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_clean_load(spark, sf_dir))


# --- windows -------------------------------------------------------------------------


@query
def hour_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = calendar_columns(F.col("datetime"))
    dated = v.load_slot(spark, sf_dir).select(
        "*", calendar["date"].alias("date"), calendar["hour"].alias("hour")
    )
    return comparable(windows.attach_hour_mean(dated).drop("date", "hour"))


@query
def ramps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(windows.ramps(v.load_slot(spark, sf_dir)).drop("block_load"))


@query
def corrected_seasonal_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-before means after a correction of one night, only the blocks it reaches made anew."""
    before = staged(v.load_filled(spark, sf_dir), "loads")
    stored = staged(windows.seasonal_lag_mean(before), "means")
    night = (F.col("datetime") >= ntz("2024-01-11 01:00:00")) & (F.col("datetime") < ntz("2024-01-11 03:00:00"))
    value = F.when(night, F.col("block_load") + 5).otherwise(F.col("block_load"))
    after = before.withColumn("block_load", value)
    anew = dirty.rebuilt(
        stored, after, before.filter(night).select(*KEYS, "datetime"), windows.seasonal_lag_mean,
        back=max(windows.DAY_BEFORE_LAGS),
    )
    return comparable(anew)


@query
def lead_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = windows.shifted(
        _training_weather(spark, sf_dir), {"apptem_ahead_1h": ("apparent_temperature", -4)}
    )
    return comparable(led.select(*KEYS, "datetime", "apptem_ahead_1h"))


@query
def limited_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(windows.limited_fill(v.load_slot(spark, sf_dir), ["block_load"]))


@query
def time_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(v.load_filled(spark, sf_dir))


@query
def weather_upsample_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = staged(weather.merge_weather(_weather_feeds(spark, sf_dir)), "weather")
    return comparable(upsample(merged, WEATHER_COLUMNS))


@query
def plain_upsample_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = staged(weather.merge_weather(_weather_feeds(spark, sf_dir)), "weather")
    return comparable(upsample(merged, WEATHER_COLUMNS, minutes=30, neighbours=False))


@query
def ewm_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = ewm_means(v.load_slot(spark, sf_dir), features.LOAD_MEANS)
    return comparable(means.drop("block_load"))


@query
def ewm_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [m.name for m in features.WEATHER_MEANS]
    return comparable(_frame(spark, sf_dir).select(*KEYS, "datetime", *names))


def _spans(df: DataFrame) -> list[DataFrame]:
    """The rows of three runs: up to the 20th, up to the 25th, and since."""
    cuts = [F.col("datetime") < ntz(t) for t in ("2024-01-20 00:00:00", "2024-01-25 00:00:00")]
    return [df.filter(cuts[0]), df.filter(~cuts[0] & cuts[1]), df.filter(~cuts[1])]


@query
def ewm_load_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of the last days from a stored state and these days alone."""
    first, second, recent = _spans(v.load_slot(spark, sf_dir))
    state = staged(ewm_state(first, features.LOAD_MEANS), "ewm-state")
    state = staged(ewm_state(second, features.LOAD_MEANS, before=state), "ewm-state")
    return comparable(ewm_means(recent, features.LOAD_MEANS, state=state).drop("block_load"))


@query
def time_interpolate_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last days filled from stored last known points and these days alone."""
    first, second, recent = _spans(v.load_slot(spark, sf_dir))
    state = staged(known_points(first, ["block_load"]), "points")
    state = staged(known_points(second, ["block_load"], before=state), "points")
    return comparable(interpolate_time(recent, ["block_load"], state=state))


@query
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = {f"avg_{n}": ("block_load", n) for n in accuracy.WINDOWS}
    rolled = windows.rolling_means(v.slot_loads(spark, sf_dir), specs, KEYS)
    return comparable(rolled.drop("block_load"))


@query
def seasonal_lag_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(windows.seasonal_lag_mean(v.load_filled(spark, sf_dir)).drop("block_load"))


# --- weather and features ------------------------------------------------------------


def _training_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = _weather_feeds(spark, sf_dir)
    return weather.training_weather_table(feeds[0], feeds[2])


@query
def training_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_training_weather(spark, sf_dir))


def _live_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.optimised_weather_table(*_weather_feeds(spark, sf_dir))


@query
def optimised_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_live_weather(spark, sf_dir))


@query
def comfort_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = calendar_columns(F.col("datetime"))
    dated = _training_weather(spark, sf_dir).select(
        "*", calendar["tb"].alias("tb"), calendar["hour"].alias("hour")
    )
    indices = features.comfort_columns()
    return comparable(
        dated.select(*KEYS, "datetime", *[c.alias(name) for name, c in indices.items()])
    )


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both tables are read several times from here on, as a job reads its snapshots.
    return features.feature_frame(
        staged(_training_load(spark, sf_dir), "load"),
        staged(_training_weather(spark, sf_dir), "weather"),
    )


@query
def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_frame(spark, sf_dir))


@query
def live_feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = load.on_grid(_clean_load(spark, sf_dir), _grid(spark, sf_dir))
    return comparable(
        features.feature_frame(
            staged(live, "load"), staged(_live_weather(spark, sf_dir), "weather")
        )
    )


# --- horizons and models -------------------------------------------------------------


@query
def horizon_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = staged(_frame(spark, sf_dir), "frame")
    return comparable(matrix.horizon_matrix(frame, before=v.AS_OF))


def _baseline_long(loads: DataFrame) -> DataFrame:
    targets = windows.seasonal_lag_mean(loads)
    long = fan_out(
        targets,
        BASELINE_HORIZONS,
        ["block_load"],
        ["load_stb", "block_load"],
        keep="block_load is not null",
    )
    return long.select(
        *KEYS,
        "datetime",
        "horizon",
        F.col("target.load_stb").alias("load_stb"),
        F.col("target.block_load").alias("target"),
    )


@query
def horizon_line_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(matrix.line_fit(_baseline_long(v.load_filled(spark, sf_dir))))


@query
def baseline_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = v.load_filled(spark, sf_dir)
    known = F.when(F.col("datetime") < ntz(v.AS_OF), F.col("block_load"))
    long = _baseline_long(filled.withColumn("block_load", known))
    complete = long.filter(F.col("load_stb").isNotNull())
    newest = publish.newest_origins(complete, v.AS_OF)
    predictions = publish.baseline_predictions(newest)
    return comparable(publish.forecast_records(predictions, "2024-01-30 00:01:00"))


def _boosted(
    spark: SparkSession,
    sf_dir: str,
    horizons: Sequence[int] = matrix.HORIZONS,
    rounds: int | None = None,
    depth: int | None = None,
) -> DataFrame:
    frame = staged(_frame(spark, sf_dir), "frame")
    training = models.stage_matrix(matrix.horizon_matrix(frame, horizons, before=v.AS_OF))
    # Small tables have horizons without one complete row; there is nothing to fit for them.
    horizons = sorted(row.horizon for row in training.select("horizon").distinct().collect())
    root = scratch_path(spark, "models")
    models.train_models(training, horizons, root, rounds=rounds, depth=depth)
    recent = matrix.horizon_matrix(frame, horizons, with_target=False, after="2024-01-29 00:00:00")
    # A few rows per series: stored once, read by every model.
    newest = staged(publish.newest_origins(recent, v.AS_OF), "newest", ["horizon"])
    predictions = models.predict(newest, horizons, root)
    return publish.forecast_records(predictions, "2024-01-30 00:01:00")


def _ridge(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    frame = staged(_frame(spark, sf_dir), "frame")
    training = staged(matrix.horizon_matrix(frame, before=v.AS_OF), "matrix")
    return training, staged(ridge.fit(training), "ridge")


@query
def ridge_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(ridge.weights(_ridge(spark, sf_dir)[1]))


@query
def ridge_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute error of the fit per series and horizon."""
    training, fits = _ridge(spark, sf_dir)
    error = F.avg(F.abs(F.col("target") - F.col("forecast"))).alias("mae")
    fitted = ridge.forecast(training, fits)
    return comparable(fitted.groupBy(*KEYS, "horizon").agg(error, F.count("*").alias("n")))


@query
def gbt_forecast_2_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All horizons' trees of the first two rounds, grown together, per series.

    Depth, step, regularisation and bagging are those of the setting table; its 700 to 1,300
    rounds are the default of ``boosting.train`` and of ``train_job``, and take hours here.
    """
    frame = staged(_frame(spark, sf_dir), "frame")
    training = staged(matrix.horizon_matrix(frame, before=v.AS_OF), "matrix")
    models_ = boosting.train(training, rounds=2)
    recent = matrix.horizon_matrix(frame, with_target=False, after="2024-01-29 00:00:00")
    predictions = boosting.forecast(publish.newest_origins(recent, v.AS_OF), models_)
    return publish.forecast_records(
        predictions.select(*KEYS, "datetime", "horizon", "forecast"), "2024-01-30 00:01:00"
    )


@query
def gbt_path_3_horizons_3_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path from matrix to records only: 3 of 157 horizons, 3 rounds of depth 3."""
    return _boosted(spark, sf_dir, SMALL_HORIZONS, rounds=3, depth=3)


# --- scores, revisions, sinks --------------------------------------------------------


@query
def forecast_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        accuracy.forecast_accuracy(
            v.demand(spark, sf_dir), v.forecast_live(spark, sf_dir), v.SCORED_AT
        )
    )


def _accuracy_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.accuracy_history(v.demand(spark, sf_dir), v.forecast_live(spark, sf_dir))


@query
def accuracy_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_accuracy_history(spark, sf_dir))


@query
def latest_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deviation.latest_revisions(v.forecast_revisions(spark, sf_dir), 2, v.AS_OF)


@query
def revision_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A forecast table is stored; here it is derived, which is cheaper twice than storing it.
    return comparable(deviation.revision_deviation(v.forecast_revisions(spark, sf_dir), v.AS_OF))


@query
def deviation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(deviation.deviation_history(v.forecast_revisions(spark, sf_dir)))


@query
def revision_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(deviation.revision_head(v.forecast_revisions(spark, sf_dir)))


@query
def latest_per_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = v.forecast_live(spark, sf_dir).select(
        *KEYS, "horizon", "date", "start_time", "created_at", "forecast"
    )
    return comparable(latest_row(stored, [*KEYS, "horizon"], ["date", "start_time"]))


@query
def new_data_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = tables.marker(_feeds(spark, sf_dir)[0])
    return publish.new_data(v.slot_loads(spark, sf_dir), processed)


@query
def forecast_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = publish.latest_records(v.forecast_live(spark, sf_dir))
    stored = staged(stored, "latest")
    is_old = F.col("created_at") < ntz(v.ACTUAL_UNTIL)
    root = scratch_path(spark, "store")
    for part in (stored.filter(is_old), stored.filter(~is_old)):
        commits.attempt(spark, root, lambda t, part=part: commits.upsert(t, "latest", part))
    return comparable(commits.read(spark, root, "latest", stored.schema))


@query
def accuracy_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _accuracy_history(spark, sf_dir).select(
        *KEYS, "date", "time", "horizon", "version", "forecast", "block_load"
    )
    scored = staged(scored, "scored")
    release_shuffles(spark)
    old = scored.filter(F.col("date") < F.to_date(ntz(v.ACTUAL_UNTIL)))
    # A second run that scores everything again, with another result.
    again = scored.withColumn("forecast", F.col("forecast") + 1)
    root = scratch_path(spark, "store")
    for batch in (old, again):
        commits.attempt(spark, root, lambda t, batch=batch: commits.insert_ignore(t, "scores", batch))
        release_shuffles(spark)
    return comparable(commits.read(spark, root, "scores", scored.schema))


@query
def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads exported as files in one order over all series, with row numbers, and read back."""
    loads = v.slot_loads(spark, sf_dir)
    path = scratch_path(spark, "export")
    ordered.export_ordered(loads, path, [*KEYS, "datetime"], form="parquet")
    return comparable(spark.read.parquet(path).drop(ordered.PART))


@query
def compacted_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads committed in three parts, then merged by day, cut to the last 20 days, and read."""
    loads = staged(v.slot_loads(spark, sf_dir).withColumn("date", F.to_date("datetime")), "loads")
    root = scratch_path(spark, "store")
    for i in range(3):
        part = loads.where(F.pmod(F.xxhash64(*KEYS), F.lit(3)) == i)
        commits.attempt(spark, root, lambda t, part=part: t.append("load", part))
    commits.compact(spark, root, "load", loads.schema, folders=1)
    commits.expire(spark, root, "load", "2024-01-10")
    commits.clean(spark, root, keep=1, grace=0)
    return comparable(commits.read(spark, root, "load", loads.schema).drop("date"))


@query
def forecast_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(publish.payload(v.forecast_live(spark, sf_dir), "load"))


@query
def forecast_payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.payload_json(v.forecast_live(spark, sf_dir), "load")


@query
def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported JSON, read again record by record."""
    sent = publish.payload_json(v.forecast_live(spark, sf_dir), "load")
    record = (
        "array<struct<date:string,start_time:string,end_time:string,source:string,"
        "forecast:double,version:string,horizon:int,revision:int>>"
    )
    return comparable(sent.select(*KEYS, F.inline(F.from_json("data", record))))


@query
def newest_stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the history are written; the newest is read."""
    history = staged(load.snapshot(_refreshed(spark, sf_dir), v.AS_OF), "history")
    root = scratch_path(spark, "snapshots")
    older = history.filter(F.col("datetime") < ntz(v.ACTUAL_UNTIL))
    sinks.write_snapshot(older, root, "2024-01-29")
    sinks.write_snapshot(history, root, "2024-01-30")
    sinks.write_snapshot(older, root, "2024-01-28")
    return comparable(sinks.newest_snapshot(spark, root))


@query
def appended_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between revisions, appended run by run and read as one table."""
    changes, held = staged_at(deviation.deviation_history(v.forecast_revisions(spark, sf_dir)), "changes")
    path = scratch_path(spark, "deviations")
    early = F.col("created_at") < ntz(v.ACTUAL_UNTIL)
    for run in (early, ~early):
        release_shuffles(spark)
        sinks.append(changes.filter(run), path)
    delete_paths(spark, held)
    return comparable(spark.read.schema(changes.schema).parquet(path))


# --- streams -------------------------------------------------------------------------

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _drained(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    ingest.drain(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_slot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ingest.read_stream(spark, sf_dir, EVENTS, "events.parquet")
    series = F.concat(F.lit("s"), F.floor(F.col("user_id") / 25).cast("string"))
    readings = events.select(series.alias("series_id"), "ts", F.col("value").alias("mw"))
    return comparable(_drained(ingest.stream_slot_mean(readings), "slots"))


@query
def stream_dense_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots without readings come out too, once the watermark has passed them."""
    events = ingest.read_stream(spark, sf_dir, EVENTS, "events.parquet")
    series = F.concat(F.lit("s"), F.floor(F.col("user_id") / 25).cast("string"))
    readings = events.select(series.alias("series_id"), "ts", F.col("value").alias("mw"))
    return comparable(_drained(slots.stream_dense_slots(readings), "dense-slots"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ingest.read_stream(spark, sf_dir, EVENTS, "events.parquet")
    return comparable(_drained(ingest.stream_dedup(events, ["event_id"]), "unique"))


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast rows arrive as files and are merged into the table of latest forecasts."""
    records = publish.latest_records(v.forecast_live(spark, sf_dir))
    arrived, out = scratch_path(spark, "arrived"), scratch_path(spark, "latest")
    records.write.parquet(arrived)
    stream = ingest.read_stream(spark, arrived, records.schema)
    ingest.drain_upserts(stream, out, scratch_path(spark, "latest-state")).awaitTermination()
    return comparable(spark.read.schema(records.schema).parquet(out).select(*records.columns))
