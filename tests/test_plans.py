"""Composite plans, sinks, jobs and streams on small inputs."""

from __future__ import annotations

import os

import tempfile
from datetime import date, datetime, timedelta

import pytest
from series_vectors import START, column
from pyspark.sql import functions as F

from slotcast.plans import accuracy, boosting, deviation, features, jobs, load, matrix, models, publish
from slotcast.plans.weather import merge_weather
from slotcast.registry.queries import REGISTRY
from slotcast.schema import ACCURACY, FORECAST, LOAD, WEATHER_COLUMNS, conform
from slotcast.session import job_stages, shared_dir, staged
from slotcast.sinks import commits
from slotcast.sinks import tables as sinks
from slotcast.sources import tables
from slotcast.sources import views as v
from slotcast.streaming import ingest


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="slotcast-test-")


def forecasts(spark, rows):
    """Rows of (origin, horizon, forecast)."""
    made = []
    for origin, horizon, value in rows:
        target = origin + timedelta(minutes=15 * horizon)
        made.append(
            (
                "a",
                target.date(),
                f"{target:%H:%M:%S}",
                f"{target + timedelta(minutes=15):%H:%M:%S}",
                float(value),
                horizon,
                "v9",
                origin + timedelta(minutes=1),
                (origin.hour * 60 + origin.minute) // 15 + 1,
            )
        )
    return spark.createDataFrame(made, FORECAST)


# --- features and matrix ---


def test_feature_buckets_cover_every_horizon():
    covered = [h for b in matrix.BUCKETS for h in range(b.first, b.last + 1)]
    assert covered == list(matrix.HORIZONS)
    assert all(b.at_target <= set(b.features) for b in matrix.BUCKETS)
    assert all(len(set(b.features)) == len(b.features) for b in matrix.BUCKETS)
    sizes = [len(b.features) for b in matrix.BUCKETS]
    assert sizes == [15, 18, 18, 19, 22, 18, 17, 17]
    assert [models.boosting_of(h).depth for h in (4, 8, 20, 40, 56, 72, 120, 160)] == [
        8,
        7,
        5,
        10,
        8,
        10,
        6,
        6,
    ]


def dense_frame(spark, series, slots=500):
    values = [500 + 10 * (i % 96) + i % 7 for i in range(slots)]
    frame = series(values)
    climate = frame.select(
        "series_id",
        "datetime",
        *[
            (F.col("block_load") / (10 + i)).alias(name)
            for i, name in enumerate(WEATHER_COLUMNS)
        ],
    )
    return values, features.feature_frame(frame, climate)


def test_matrix_rows_hold_the_load_of_the_target_slot(spark, series):
    values, frame = dense_frame(spark, series)
    cut = "2024-01-05 00:00:00"
    rows = matrix.horizon_matrix(staged(frame), [4, 20, 96, 160], before=cut)
    got = rows.select("datetime", "horizon", "block_load", "target", "tb", "load_stb").collect()
    assert {r["horizon"] for r in got} == {4, 20, 96, 160}
    for r in got:
        i = int((r["datetime"] - START).total_seconds() // 900)
        target = i + r["horizon"]
        assert r["datetime"] < datetime(2024, 1, 5)
        assert (r["block_load"], r["target"]) == (values[i], values[target])
        assert r["tb"] == target % 96 + 1
        day_before = values[target - 96] + values[target - 97] + values[target - 95]
        want = day_before / 3 if r["horizon"] == 20 else None
        assert r["load_stb"] == (pytest.approx(want) if want else None)
    # Ramp needs the load four slots back, so origins 0-3 have no row at horizon 4.
    assert sum(r["horizon"] == 4 for r in got) == 4 * 96 - 4
    assert sum(r["horizon"] == 160 for r in got) == 500 - 160


def test_scoring_matrix_needs_no_target(spark, series):
    _, frame = dense_frame(spark, series)
    rows = matrix.horizon_matrix(
        staged(frame), [4], with_target=False, after="2024-01-06 00:00:00"
    )
    assert "target" not in rows.columns
    assert column(rows, "datetime")[0] == datetime(2024, 1, 6)


def test_weather_outside_the_load_grid_has_no_load_features(spark, series):
    loads = series([500.0] * 10)
    climate = series([20.0] * 20, name="temperature").select(
        "series_id", "datetime", *[F.col("temperature").alias(c) for c in WEATHER_COLUMNS]
    )
    frame = features.feature_frame(loads, climate)
    assert column(frame, "load_wm2h")[9:12] == [pytest.approx(500), None, None]
    assert len(column(frame, "temp_mean_3h")) == 20


def test_merge_weather_prefers_the_first_feed(series):
    def feed(values):
        one = series(values, minutes=60, name="t")
        return one.select(
            "series_id", "datetime", *[F.col("t").alias(c) for c in WEATHER_COLUMNS]
        )

    merged = merge_weather([feed([1]), feed([2, 2]), feed([3, 3, 3])])
    assert column(merged, "temperature") == [1, 2, 3]


def test_holidays_become_null_slots(spark, series):
    loads = series([500.0] * 192)
    holidays = spark.createDataFrame([(date(2024, 1, 1),)], "date date")
    cleaned = load.training_load(loads, holidays)
    on_grid = load.on_grid(cleaned, loads.select("series_id", "datetime"))
    assert column(on_grid, "block_load") == [None] * 96 + [500.0] * 96


def test_baseline_line_fit(spark):
    rows = [("a", 4, float(x), 3.0 * x + 1) for x in range(10)]
    df = spark.createDataFrame(rows, "series_id string, horizon int, load_stb double, target double")
    got = matrix.line_fit(df).first()
    assert (got["slope"], got["intercept"], got["n"]) == (pytest.approx(3), pytest.approx(1), 10)


# --- accuracy and deviation ---


def test_accuracy_windows_precede_fill_and_cut(spark):
    demand = spark.createDataFrame(
        [
            ("a", (START + timedelta(minutes=15 * i)).date(), f"{START + timedelta(minutes=15 * i):%H:%M:%S}", 100.0)
            for i in range(60)
            if i != 30
        ],
        "series_id string, date date, timeslot string, actual_demand_met_mw double",
    )
    made = [(START + timedelta(minutes=15 * (i - 4)), 4, 90.0) for i in range(60)]
    got = accuracy.forecast_accuracy(
        demand, forecasts(spark, made), "2024-01-01 13:00:00", horizons=[4], days=0
    )
    rows = {r["time"]: r for r in got.collect()}
    # Origins of the first four slots lie on the day before, their targets do not.
    assert len(rows) == 36 and max(rows) == "12:30:00" and min(rows) == "03:45:00"
    assert rows["12:30:00"]["mae_4"] == 10 and rows["12:30:00"]["mae_96"] == 0
    assert rows["07:30:00"]["block_load"] == 0 and rows["07:30:00"]["mae"] == 0
    assert rows["08:15:00"]["mae_4"] == 0 and rows["08:30:00"]["mae_4"] == 10


def test_deviation_aligns_consecutive_revisions(spark):
    older, newer = START, START + timedelta(minutes=15)
    rows = [(older, h, 100.0) for h in range(4, 40)] + [(newer, h, 100.0 + h) for h in range(4, 40)]
    rows += [(older - timedelta(minutes=15), h, 0.0) for h in range(4, 40)]
    got = deviation.revision_deviation(forecasts(spark, rows)).orderBy("date", "start_time")
    out = got.collect()
    assert len(out) == 17
    assert [r["deviation"] for r in out] == [float(h) for h in range(4, 21)]
    assert {r["deviation_value"] for r in out} == {0}
    assert {r["created_at"] for r in out} == {newer + timedelta(minutes=1)}
    assert {r["previous_revision_forecast"] for r in out} == {100.0}
    flagged = deviation.revision_deviation(forecasts(spark, rows), threshold=10).collect()
    assert sum(r["deviation_value"] for r in flagged) == 10
    history = deviation.deviation_history(forecasts(spark, rows))
    assert history.count() == 34


# --- publishing and gate ---


def test_publish_layout(spark):
    made = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 23, 30), 4, 7.0)],
        "series_id string, datetime timestamp_ntz, horizon int, forecast double",
    )
    row = publish.forecast_records(made, "2024-01-01 23:46:00").first()
    assert (row["date"], row["start_time"], row["end_time"]) == (
        date(2024, 1, 2),
        "00:30:00",
        "00:45:00",
    )
    assert (row["revision_no"], row["version"]) == (95, "v9")
    text = publish.payload_json(publish.forecast_records(made, "2024-01-01 23:46:00"), "x").first()
    assert text["data"] == (
        '[{"date":"2024-01-02","start_time":"00:30:00","end_time":"00:45:00","source":"x",'
        '"forecast":7.0,"version":"v1","horizon":4,"revision":0}]'
    )


def test_gate(spark, series):
    loads = series([1, 2, None])
    old = spark.createDataFrame([("a", START)], "series_id string, datetime timestamp_ntz")
    done = old.withColumn("datetime", F.lit(START + timedelta(minutes=15)).cast("timestamp_ntz"))
    assert publish.new_data(loads, old).count() == 1
    assert publish.new_data(loads, done).count() == 0
    assert publish.new_data(loads, old.limit(0)).count() == 1
    assert publish.gated(loads, done).count() == 0


# --- sinks ---


def test_upsert_twice_is_once(spark, folder):
    path = f"{folder}/latest"
    first = publish.latest_records(forecasts(spark, [(START, 4, 1.0), (START, 5, 2.0)]))
    later = START + timedelta(minutes=15)
    second = publish.latest_records(
        forecasts(spark, [(later, 4, 9.0), (later, 200, 3.0)])
    )
    sinks.upsert(first, path)
    sinks.upsert(second, path)
    once = {tuple(r) for r in spark.read.parquet(path).select(*first.columns).collect()}
    sinks.upsert(second, path)
    rows = spark.read.parquet(path).select(*first.columns).collect()
    assert {tuple(r) for r in rows} == once and len(rows) == 3
    by_slot = {(r["date"], r["start_time"]): r for r in rows}
    updated = by_slot[date(2024, 1, 1), "01:15:00"]
    assert (updated["forecast"], updated["horizon"]) == (9.0, 4)
    assert updated["created_at"] == later + timedelta(minutes=1)


def test_upsert_keeps_columns_that_are_not_updated(spark):
    old = spark.createDataFrame([(1, "old", 1.0, 1)], "k int, note string, x double, at int")
    new = spark.createDataFrame([(1, "new", 2.0, 2), (2, "new", 5.0, 2)], old.schema)
    merged = sinks.upsert_merge(old, new, ["k"], ["x", "at"], ["at"])
    assert {tuple(r) for r in merged.collect()} == {(1, "old", 2.0, 2), (2, "new", 5.0, 2)}


def test_insert_ignore_twice_is_once(spark, folder):
    path = f"{folder}/acc"
    rows = spark.createDataFrame(
        [("a", date(2024, 1, 1), "00:00:00", 4, "v9", 1.0)],
        "series_id string, date date, time string, horizon int, version string, mae double",
    )
    sinks.insert_ignore(rows, path)
    sinks.insert_ignore(rows.withColumn("mae", F.lit(5.0)), path)
    more = rows.withColumn("time", F.lit("00:15:00"))
    sinks.insert_ignore(more.unionByName(more.withColumn("mae", F.lit(2.0))), path, order=["mae"])
    assert [r["mae"] for r in spark.read.parquet(path).orderBy("time").collect()] == [1.0, 1.0]


def test_snapshot_versions_and_exports(spark, series, folder):
    loads = series([1.0, 2.0])
    sinks.write_snapshot(loads, f"{folder}/load", "1")
    assert sinks.read_snapshot(spark, f"{folder}/load", "1").count() == 2
    sinks.write_snapshot(loads.limit(1), f"{folder}/load", "2")
    assert sinks.newest_snapshot(spark, f"{folder}/load").count() == 1
    sinks.write_snapshot(loads, f"{folder}/load", "2", replace=True)
    assert sinks.newest_snapshot(spark, f"{folder}/load").count() == 2
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.write_snapshot(loads, f"{folder}/load", "1")
    sinks.export_csv(loads, f"{folder}/csv")
    again = tables.read_table(spark, {"path": f"{folder}/csv", "header": "true"}, LOAD, "csv")
    assert column(again, "block_load") == [1.0, 2.0]
    sinks.export_json(loads, f"{folder}/json")
    assert spark.read.json(f"{folder}/json").count() == 2


def test_conform_turns_nan_into_null(spark):
    df = spark.createDataFrame([("a", START, float("nan"))], "series_id string, datetime timestamp_ntz, block_load double")
    assert conform(df, LOAD).first()["block_load"] is None


def test_source_filters_reach_the_files(spark, sf_dir):
    frame = tables.since(staged(v.slot_loads(spark, sf_dir)), "2024-01-20 00:00:00")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(datetime), GreaterThanOrEqual(datetime" in plan


def test_checkpoint_folder_comes_from_the_session(spark, series):
    assert shared_dir(spark)
    with job_stages(spark):
        kept = staged(series([1.0]))
        assert kept.count() == 1 and os.path.exists(kept.inputFiles()[0].removeprefix("file://"))
        path = kept.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(path)


# --- streams ---


def test_stream_slot_mean_equals_batch(spark, sf_dir):
    got = {tuple(r) for r in REGISTRY["stream_slot_load"](spark, sf_dir).select("series_id", "datetime").collect()}
    newest = v.load_obs(spark, sf_dir).agg(F.max("ts")).first()[0]
    closed = v.slot_loads(spark, sf_dir).filter(
        F.col("datetime") + F.expr("interval 15 minutes") <= F.lit(newest - timedelta(hours=1)).cast("timestamp_ntz")
    )
    assert got == {tuple(r) for r in closed.select("series_id", "datetime").collect()}


def test_stream_upsert_runs_once_per_file(spark, folder):
    source, path, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    records = publish.latest_records(forecasts(spark, [(START, 4, 1.0)]))
    records.write.parquet(source)

    def run():
        stream = ingest.read_stream(spark, source, records.schema)
        query = ingest.drain_upserts(stream, path, state)
        query.awaitTermination()
        return len(query.recentProgress) and sum(p["numInputRows"] for p in query.recentProgress)

    assert run() == 1
    assert run() == 0
    later = START + timedelta(minutes=15)
    publish.latest_records(forecasts(spark, [(later, 4, 2.0), (later, 3, 8.0)])).write.mode("append").parquet(source)
    assert run() == 2
    assert sorted(r["forecast"] for r in spark.read.parquet(path).collect()) == [2.0, 8.0]


# --- jobs ---


def test_jobs_end_to_end(spark, series, folder):
    store = jobs.Store(folder)
    slots = 14 * 96
    values = [500 + 10 * (i % 96) + i % 13 for i in range(slots)]
    loads = series(values)
    climate = loads.filter(F.minute("datetime") == 0).select(
        "series_id",
        "datetime",
        *[(F.col("block_load") / (20 + i)).alias(c) for i, c in enumerate(WEATHER_COLUMNS)],
    )
    ahead = climate.select(
        "series_id",
        (F.col("datetime") + F.expr("interval 14 days")).alias("datetime"),
        *WEATHER_COLUMNS,
    )
    as_of = "2024-01-14 12:00:00"
    known = loads.filter(F.col("datetime") < F.lit(datetime(2024, 1, 14, 12)).cast("timestamp_ntz"))
    none = spark.createDataFrame([], "date date")
    for _ in range(2):
        path = jobs.train_job(
            known, known, climate.limit(0), [climate, ahead], none, store, as_of,
            horizons=[4, 24], start="2024-01-01 00:00:00", first_origin="2024-01-01 00:00:00",
            warm_floor=0, rounds=2, growth=[boosting.Growth(4, 160, 0.3, 2, 5)],
        )
        assert {r.horizon for r in spark.read.parquet(path).collect()} == {4, 24}
    assert sinks.read_snapshot(spark, store.load, "2024-01-14").count() == 13 * 96

    nothing = jobs.stored_marker(spark, store)
    assert nothing.isEmpty()

    def forecast(now, rows, processed):
        return jobs.forecast_job(
            [rows], [climate, climate.limit(0), ahead], processed, store, now,
            start="2024-01-01 00:00:00", horizons=[4, 24], warm_floor=0,
        )

    records = forecast(as_of, known, nothing)
    assert sorted((r["horizon"], r["start_time"]) for r in records.collect()) == [
        (4, "12:45:00"),
        (24, "17:45:00"),
    ]
    assert all(300 < r["forecast"] < 1700 for r in records.collect())
    assert forecast(as_of, known, jobs.stored_marker(spark, store)) is None
    state = commits.manifest(spark, store.tables)
    assert state.version == 1 and set(state.tables) == {jobs.FORECASTS, jobs.LATEST}
    stored = commits.read(spark, store.tables, jobs.FORECASTS, FORECAST).count()
    history = sinks.newest_snapshot(spark, store.load)
    again = jobs.forecast_job(
        [tables.since(known, "2024-01-10 00:00:00")], [climate, climate.limit(0), ahead], nothing,
        store, as_of, start="2024-01-01 00:00:00", horizons=[4, 24], warm_floor=0, history=history,
    )
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in records.collect()}
    assert commits.read(spark, store.tables, jobs.FORECASTS, FORECAST).count() == stored == 2
    jobs.deviation_job(spark, store)

    demand = loads.select(
        "series_id",
        F.to_date("datetime").alias("date"),
        F.date_format("datetime", "HH:mm:ss").alias("timeslot"),
        F.col("block_load").alias("actual_demand_met_mw"),
    )
    for _ in range(2):
        jobs.accuracy_job(demand, store, "2024-01-14 23:00:00")
    scored = commits.read(spark, store.tables, jobs.SCORES, ACCURACY)
    assert scored.count() == 2 and scored.filter("mae > 0").count() == 2
    jobs.upkeep_job(spark, store, "2024-01-14 23:00:00", days=30)
    assert commits.read(spark, store.tables, jobs.SCORES, ACCURACY).count() == 2
    jobs.upkeep_job(spark, store, "2024-02-14 23:00:00", days=30)
    assert commits.read(spark, store.tables, jobs.SCORES, ACCURACY).count() == 0


def test_every_revision_is_linked_to_the_one_before_it(spark):
    times = [START + timedelta(minutes=m) for m in (1, 16, 1441, 1456, 7 * 1440, 7 * 1440 + 15, 7 * 1440 + 15)]
    rows = [("a", t) for t in times] + [("b", times[2]), ("c", None)]
    stored = spark.createDataFrame(rows, "series_id string, created_at timestamp_ntz")
    have = sorted(tuple(r) for r in deviation.previous_revisions(stored).collect())
    single = sorted(set(times))
    assert have == [("a", new, old) for old, new in zip(single, single[1:])]
