"""The final SQL of each oracle; the steps it builds on are in ``oracles.py``."""

from __future__ import annotations

from collections.abc import Iterable

from slotcast.plans.features import LOAD_MEANS, WEATHER_MEANS
from slotcast.plans.matrix import FEATURES
from slotcast.registry.oracles import (
    CALENDAR,
    CALENDAR_NAMES,
    HUMIDEX,
    RH,
    TB,
    _accuracy_layout,
    _in_season,
    _list,
    _rolling,
    _scored,
    compose,
    cut,
    filled,
    regular,
    ts,
    weighted,
)
from slotcast.schema import WEATHER_COLUMNS
from slotcast.sources import views as v

LOAD = ["block_load"]
WHOLE = {"dow", "year", "month", "tb"}
RAMPS = [f"ramp{k}" for k in range(1, 5)]
FRAME_REALS = [
    *LOAD,
    *WEATHER_COLUMNS,
    *RAMPS,
    "hour_mean",
    "load_stb",
    *(m.name for m in LOAD_MEANS),
    *(m.name for m in WEATHER_MEANS),
    "humidex",
    "RH",
    "tb_aptemp",
    "hour_temp",
]
TODAY = ts(v.AS_OF)
REFRESH = ts("2024-01-23 00:00:00")
TWO_DAYS = "BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'"
BY_TIME = "WINDOW s AS (PARTITION BY series_id ORDER BY datetime)"
DAY_BEFORE = (
    "(lag(block_load, 96) OVER s + lag(block_load, 97) OVER s + lag(block_load, 95) OVER s) / 3"
)
BASELINE_HORIZONS = "(SELECT CAST(unnest(range(20, 96)) AS INTEGER) AS horizon)"


def _reals(names: Iterable[str]) -> str:
    return ", ".join(cut(n) for n in names)


def _series(names: Iterable[str], source: str) -> str:
    return f"SELECT series_id, datetime, {_reals(names)} FROM {source}"


def _cascade_variants() -> str:
    live = ["temperature", "dew_point", "apparent_temperature", "humidity"]
    every = live + ["cloud_cover", "wind_bearing", "wind_speed"]
    parts = []
    for name, floor, masked in (("live", 2, live), ("training", 3, every)):
        values = [
            cut(f"CASE WHEN temperature >= {floor} THEN {c} END", c) if c in masked else cut(c)
            for c in WEATHER_COLUMNS
        ]
        parts.append(
            f"SELECT '{name}' AS variant, series_id, feed, datetime, {', '.join(values)}"
            " FROM weather_feed"
        )
    return " UNION ALL ".join(parts)


def _weather_scans() -> str:
    scans = (
        ("actual", "actual", v.FIRST_SLOT),
        ("optimised", "optimised", v.FIRST_SLOT),
        ("forecast", "forecast_weather", "2024-01-27 00:00:00"),
    )
    return " UNION ALL ".join(
        f"SELECT '{name}' AS source, series_id, datetime, {_reals(WEATHER_COLUMNS)}"
        f" FROM {table} WHERE datetime >= {ts(since)}"
        for name, table, since in scans
    )


def _ramps() -> str:
    lags = ["block_load"] + [f"lag(block_load, {k}) OVER s" for k in range(1, 5)]
    values = [cut(f"{lags[k - 1]} - {lags[k]}", f"ramp{k}") for k in range(1, 5)]
    return f"SELECT series_id, datetime, {', '.join(values)} FROM load_slot {BY_TIME}"


def _rolling_load() -> str:
    windows = ", ".join(
        f"r{n} AS (PARTITION BY series_id ORDER BY datetime"
        f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (4, 12, 96)
    )
    values = ", ".join(
        cut(
            f"CASE WHEN count(block_load) OVER r{n} = {n} THEN avg(block_load) OVER r{n} END",
            f"avg_{n}",
        )
        for n in (4, 12, 96)
    )
    return f"SELECT series_id, datetime, {values} FROM slots WINDOW {windows}"


REFRESHED = f"""
    SELECT series_id, datetime, block_load FROM fed WHERE datetime < {TODAY}
    UNION
    SELECT series_id, datetime, block_load FROM fed WHERE datetime >= {REFRESH}"""

COMPARED = f"""
    SELECT series_id, date, start_time, end_time,
        {cut('previous', 'previous_revision_forecast')},
        {cut('forecast', 'current_revision_forecast')},
        {cut('abs(forecast - previous)', 'deviation')},
        CASE WHEN abs(forecast - previous) > 30 THEN 1 ELSE 0 END AS deviation_value,
        created_at, revision_no
    FROM (
        SELECT *, lag(forecast) OVER slot AS previous, lag(place) OVER slot AS previous_place,
            lag(number) OVER slot AS previous_number
        FROM placed
        WINDOW slot AS (PARTITION BY series_id, date, start_time, end_time ORDER BY number)
    )
    WHERE place <= 17 AND previous_place BETWEEN 2 AND 18 AND previous_number = number - 1"""

EXTRA = {
    "pairs": f"""
    SELECT t.series_id, t.datetime, h.horizon, t.load_stb, t.block_load AS target
    FROM (
        SELECT series_id, datetime, block_load, load_stb, slot,
            min(slot) FILTER (WHERE block_load IS NOT NULL) OVER (PARTITION BY series_id) AS first_known
        FROM (
            SELECT series_id, datetime, block_load, load_stb, row_number() OVER s AS slot
            FROM targets {BY_TIME}
        )
    ) t, {BASELINE_HORIZONS} h
    WHERE slot - horizon >= first_known""",
    "known_loads": f"SELECT * FROM load_filled WHERE datetime < {TODAY}",
    "known_targets": f"""
    SELECT series_id, datetime, {DAY_BEFORE} AS load_stb
    FROM grid LEFT JOIN known_loads USING (series_id, datetime) {BY_TIME}""",
    "newest_known": """
    SELECT series_id, max(datetime) AS datetime FROM known_loads
    WHERE block_load IS NOT NULL GROUP BY 1""",
    "newest_targets": f"""
    SELECT series_id, datetime, horizon, datetime + to_minutes(15 * horizon) AS target_at
    FROM newest_known, {BASELINE_HORIZONS}""",
    "slots_two_days": f"SELECT * FROM slots WHERE CAST(datetime AS DATE) {TWO_DAYS}",
    "demand_two_days": regular("slots_two_days", 15, LOAD),
    "forecasts_two_days": f"SELECT * FROM forecast_live WHERE date {TWO_DAYS}",
    "scored_two_days": _rolling(
        f"({_scored('demand_two_days', 'forecasts_two_days')})",
        "series_id, horizon",
        "datetime, revision_no",
    ),
    "closing": f"""
    SELECT * FROM scored_two_days
    WHERE datetime < {ts(v.SCORED_AT)} - INTERVAL '15 minutes'
    QUALIFY row_number() OVER (
        PARTITION BY series_id, horizon ORDER BY datetime DESC, revision_no DESC) <= 36""",
    "demand_all": regular("slots", 15, LOAD),
    "scored_all": _rolling(
        f"({_scored('demand_all', 'forecast_live')})",
        "series_id, horizon",
        "datetime, revision_no",
    ),
    "revisions": f"""
    SELECT series_id, created_at,
        row_number() OVER (PARTITION BY series_id ORDER BY created_at DESC) AS newest
    FROM (SELECT DISTINCT series_id, created_at FROM forecast_revisions
        WHERE created_at <= {TODAY})""",
    "last_two": """
    SELECT * FROM (SELECT DISTINCT series_id, created_at FROM forecast_live)
    QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY created_at DESC) <= 2""",
    "placed": f"""
    SELECT *, row_number() OVER (PARTITION BY series_id, created_at ORDER BY horizon) AS place,
        dense_rank() OVER (PARTITION BY series_id ORDER BY created_at) AS number,
        max(created_at) FILTER (WHERE created_at <= {TODAY})
            OVER (PARTITION BY series_id) AS last_created
    FROM forecast_revisions QUALIFY place <= 18""",
}

N = len(FEATURES)
RIDGE = {
    # sums of all products of deviations from the mean, the target last
    "feature_means": f"""
    SELECT series_id, horizon, {", ".join(f"avg({f}) AS {f}" for f in (*FEATURES, "target"))}
    FROM matrix GROUP BY series_id, horizon""",
    "apart": f"""
    SELECT x.series_id, x.horizon,
        {", ".join(f"coalesce(x.{f} - m.{f}, 0.0::DOUBLE) AS {f}" for f in (*FEATURES, "target"))}
    FROM matrix x JOIN feature_means m ON m.series_id = x.series_id AND m.horizon = x.horizon""",
    "products": f"""
    SELECT series_id, horizon, count(*) AS n,
        {", ".join(f"sum({a} * {b}) / count(*) AS p{i}_{j}" for i, a in enumerate(FEATURES) for j, b in enumerate((*FEATURES, "target")) if i <= j)}
    FROM apart GROUP BY series_id, horizon""",
    "spread": f"""
    SELECT p.*, [{", ".join(f"CASE WHEN p{i}_{i} > 1e-12 * (1 + coalesce(m.{f}, 0) ** 2) THEN sqrt(p{i}_{i}) ELSE 0 END" for i, f in enumerate(FEATURES))}] AS dev
    FROM products p JOIN feature_means m USING (series_id, horizon)""",
    "equations": f"""
    SELECT series_id, horizon, dev, [{", ".join(
        "[" + ", ".join(
            f"CASE WHEN dev[{i + 1}] > 0 AND dev[{j + 1}] > 0 THEN p{min(i, j)}_{max(i, j)} / (dev[{i + 1}] * dev[{j + 1}]) ELSE 0 END"
            + (" + 0.1" if i == j else "") for j in range(N)
        ) + f", CASE WHEN dev[{i + 1}] > 0 THEN p{i}_{N} / dev[{i + 1}] ELSE 0 END]" for i in range(N)
    )}] AS m
    FROM spread""",
    "solved": f"""
    WITH RECURSIVE eliminated AS (
        SELECT series_id, horizon, dev, 1 AS k, m FROM equations
        UNION ALL
        SELECT series_id, horizon, dev, k + 1, list_transform(m, lambda r, i: CASE
            WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
            ELSE list_transform(r, lambda x, j: x - r[k] / m[k][k] * m[k][j]) END)
        FROM eliminated WHERE k <= {N})
    SELECT series_id, horizon, dev, list_transform(m, lambda r: r[{N + 1}]) AS w FROM eliminated WHERE k = {N + 1}""",
}

FINAL = {
    "ridge_weights": f"""
    SELECT series_id, horizon, feature, {cut('weight')} FROM (
        SELECT series_id, horizon, unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) AS feature,
            unnest(dev) AS dev, unnest(w) AS weight FROM solved) WHERE dev > 0""",
    "ridge_error": f"""
    SELECT series_id, horizon, {cut("avg(abs(x.target - (" + " + ".join(
        f"CASE WHEN s.dev[{i + 1}] > 0 THEN s.w[{i + 1}] * x.{f} / s.dev[{i + 1}] ELSE 0 END" for i, f in enumerate(FEATURES)
    ) + ")))", "mae")}, count(*) AS n
    FROM apart x JOIN solved s USING (series_id, horizon) GROUP BY series_id, horizon""",
    "slot_load": f"SELECT series_id, datetime, {CALENDAR}, {_reals(LOAD)} FROM load_slot",
    "tumbling_mean": _series(LOAD, "demand_all"),
    "load_floor_mask": f"""
    SELECT o_orderkey, datetime, CAST(month(datetime) AS INTEGER) AS month,
        CASE WHEN month(datetime) BETWEEN 4 AND 10 THEN 2 ELSE 1 END AS season,
        {cut(_in_season('block_load', v.PRICE_FLOOR, v.WARM_PRICE_FLOOR), 'block_load')}
    FROM (SELECT o_orderkey, o_orderdate AS datetime, CAST(o_totalprice AS DOUBLE) AS block_load
        FROM orders)""",
    "weather_cascade_mask": _cascade_variants(),
    "source_priority_union": _series(LOAD, "fed"),
    "union_distinct_refresh": _series(LOAD, f"({REFRESHED})"),
    "refreshed_load": f"""
    SELECT series_id, datetime, {cut(f'block_load + CASE WHEN datetime >= {REFRESH} THEN 1 ELSE 0 END', 'block_load')}
    FROM fed""",
    "history_snapshot": f"{_series(LOAD, f'({REFRESHED})')} WHERE datetime < {TODAY}",
    "retained_load": f"{_series(LOAD, 'slots')} WHERE datetime >= {TODAY} - INTERVAL '360 days'",
    "ordered_export": f"""
    SELECT series_id, datetime, {cut('block_load')},
        row_number() OVER (ORDER BY series_id, datetime) - 1 AS row_no FROM slots""",
    "compacted_retention": f"{_series(LOAD, 'slots')} WHERE datetime >= TIMESTAMP '2024-01-10'",
    "weather_priority_merge": _series(WEATHER_COLUMNS, "weather_merged"),
    "weather_scans": _weather_scans(),
    "demand_scan": f"""
    SELECT series_id, ts, {cut('mw')} FROM obs WHERE CAST(ts AS DATE) {TWO_DAYS}""",
    "forecast_scan": f"""
    SELECT * EXCLUDE (forecast), {cut('forecast')} FROM forecasts_two_days
    WHERE version = 'v9'""",
    "holiday_exclusion": _series(LOAD, "training_load"),
    "hour_mean": f"""
    SELECT series_id, datetime, {_reals(LOAD)}, {cut(
        'avg(block_load) OVER (PARTITION BY series_id, CAST(datetime AS DATE), hour(datetime))',
        'hour_mean')}
    FROM load_slot""",
    "ramps": _ramps(),
    "corrected_seasonal_mean": f"""
    SELECT series_id, datetime, {cut('block_load')}, {cut('load_stb')} FROM (
        SELECT *, (lag(block_load, 96) OVER s + lag(block_load, 97) OVER s
            + lag(block_load, 95) OVER s) / 3 AS load_stb
        FROM (SELECT series_id, datetime, block_load + CASE
            WHEN datetime >= TIMESTAMP '2024-01-11 01:00:00' AND datetime < TIMESTAMP '2024-01-11 03:00:00'
            THEN 5 ELSE 0 END AS block_load FROM load_filled)
        WINDOW s AS (PARTITION BY series_id ORDER BY datetime))""",
    "lead_features": f"""
    SELECT series_id, datetime, {cut('lead(apparent_temperature, 4) OVER s', 'apptem_ahead_1h')}
    FROM training_weather {BY_TIME}""",
    "limited_fill": _series(LOAD, f"({filled('load_slot', LOAD)})"),
    "time_interpolate": _series(LOAD, "load_filled"),
    "weather_upsample_15m": _series(WEATHER_COLUMNS, "weather_15"),
    "plain_upsample_30m": _series(WEATHER_COLUMNS, "weather_30"),
    "optimised_weather": _series(WEATHER_COLUMNS, "live_weather"),
    "training_weather": _series(WEATHER_COLUMNS, "training_weather"),
    "ewm_load": _series((m.name for m in LOAD_MEANS), f"({weighted('load_slot', LOAD_MEANS)})"),
    "ewm_load_resumed": _series((m.name for m in LOAD_MEANS), f"({weighted('load_slot', LOAD_MEANS)})")
    + " WHERE datetime >= TIMESTAMP '2024-01-25'",
    "time_interpolate_resumed": _series(LOAD, "load_filled") + " WHERE datetime >= TIMESTAMP '2024-01-25'",
    "ewm_weather": _series((m.name for m in WEATHER_MEANS), "framed_weather_means"),
    "comfort_indices": f"""
    SELECT series_id, datetime, {cut(HUMIDEX, 'humidex')}, {cut(RH, 'RH')},
        {cut(TB.format('datetime') + ' * apparent_temperature', 'tb_aptemp')},
        {cut('(hour(datetime) + 1) * temperature', 'hour_temp')}
    FROM training_weather""",
    "seasonal_lag_mean": _series(["load_stb"], "targets"),
    "rolling_mean": _rolling_load(),
    "clean_load": f"""
    SELECT series_id, datetime, CAST(datetime AS DATE) AS date,
        {TB.format('datetime')} AS tb, {_reals(LOAD)} FROM clean_load""",
    "feature_frame": f"""
    SELECT series_id, datetime, {_list(CALENDAR_NAMES)}, {_reals(FRAME_REALS)} FROM framed""",
    "live_feature_frame": f"""
    SELECT series_id, datetime, {_list(CALENDAR_NAMES)}, {_reals(FRAME_REALS)} FROM live_framed""",
    "horizon_matrix": f"""
    SELECT series_id, datetime, horizon, {_list(n for n in FEATURES if n in WHOLE)},
        {_reals(n for n in FEATURES if n not in WHOLE)}, {_reals(['target'])} FROM matrix""",
    "horizon_line_fit": f"""
    SELECT series_id, horizon, {cut('regr_slope(target, load_stb)', 'slope')},
        {cut('regr_intercept(target, load_stb)', 'intercept')},
        CAST(regr_count(target, load_stb) AS BIGINT) AS n
    FROM pairs WHERE load_stb IS NOT NULL AND target IS NOT NULL
    GROUP BY series_id, horizon""",
    "baseline_forecast": f"""
    SELECT n.series_id, CAST(target_at AS DATE) AS date,
        strftime(target_at, '%H:%M:%S') AS start_time,
        strftime(target_at + INTERVAL '15 minutes', '%H:%M:%S') AS end_time,
        {cut('load_stb', 'forecast')}, horizon, 'v9' AS version,
        {TODAY} + INTERVAL '1 minute' AS created_at,
        {TB.format('n.datetime')} AS revision_no
    FROM newest_targets n JOIN known_targets t
        ON t.series_id = n.series_id AND t.datetime = n.target_at""",
    "forecast_accuracy": _accuracy_layout("closing"),
    "accuracy_history": _accuracy_layout("scored_all"),
    "latest_revisions": """
    SELECT series_id, created_at, CAST(newest AS INTEGER) AS newest
    FROM revisions WHERE newest <= 2""",
    "revision_scan": f"""
    SELECT * EXCLUDE (forecast), {cut('forecast')} FROM forecast_live f
    WHERE EXISTS (SELECT 1 FROM last_two r
        WHERE r.series_id = f.series_id AND r.created_at = f.created_at)""",
    "revision_deviation": f"{COMPARED} AND created_at = last_created",
    "deviation_history": COMPARED,
    "latest_per_horizon": f"""
    SELECT series_id, horizon, date, start_time, created_at, {cut('forecast')}
    FROM forecast_live
    QUALIFY row_number() OVER (
        PARTITION BY series_id, horizon ORDER BY date DESC, start_time DESC) = 1""",
    "new_data_gate": """
    SELECT l.series_id, l.datetime, m.datetime AS processed_until
    FROM (SELECT series_id, max(datetime) AS datetime FROM slots GROUP BY 1) l
    LEFT JOIN (SELECT series_id, max(datetime) AS datetime FROM feed_slots WHERE source = 0
        GROUP BY 1) m ON m.series_id = l.series_id
    WHERE m.datetime IS NULL OR l.datetime > m.datetime""",
    "forecast_upsert": f"""
    SELECT series_id, date, start_time, end_time, {cut('forecast')}, horizon,
        'v1' AS version, created_at
    FROM forecast_live
    QUALIFY row_number() OVER (PARTITION BY series_id, date, start_time
        ORDER BY created_at >= {ts(v.ACTUAL_UNTIL)} DESC, created_at DESC, horizon DESC) = 1""",
    "accuracy_insert_ignore": f"""
    SELECT series_id, date, time, horizon, version, {_reals(['forecast', 'block_load'])}
    FROM (
        SELECT series_id, CAST(datetime AS DATE) AS date,
            strftime(datetime, '%H:%M:%S') AS time, horizon, version,
            forecast + CASE WHEN datetime >= {ts(v.ACTUAL_UNTIL)} THEN 1 ELSE 0 END AS forecast,
            coalesce(block_load, 0) AS block_load
        FROM scored_all
    )""",
    "forecast_payload": f"""
    SELECT series_id, strftime(date, '%Y-%m-%d') AS date, start_time, end_time,
        'load' AS source, {cut('forecast')}, 'v1' AS version, horizon, 0 AS revision
    FROM forecast_live""",
    "stream_upsert": f"""
    SELECT series_id, date, start_time, end_time, {cut('forecast')}, horizon,
        'v1' AS version, created_at
    FROM forecast_live
    QUALIFY row_number() OVER (PARTITION BY series_id, date, start_time
        ORDER BY created_at DESC, horizon DESC) = 1""",
    "revision_head": f"""
    SELECT * EXCLUDE (forecast, place, number, last_created), {cut('forecast')}
    FROM placed WHERE place <= 17""",
    "stream_slot_load": f"""
    {_series(LOAD, 'slots')}
    WHERE datetime + INTERVAL '15 minutes'
        <= (SELECT time_bucket(INTERVAL '1 millisecond', max(ts)) FROM obs) - INTERVAL '1 hour'""",
    "stream_dense_slots": f"""
    {_series(LOAD, "(SELECT * FROM (SELECT series_id, unnest(generate_series(min(datetime), " + ts(v.LAST_SLOT)
        + ", INTERVAL '15 minutes')) AS datetime FROM slots GROUP BY series_id) LEFT JOIN slots USING (series_id, datetime))")}
    WHERE datetime + INTERVAL '15 minutes'
        <= (SELECT time_bucket(INTERVAL '1 millisecond', max(ts)) FROM obs) - INTERVAL '1 hour'""",
    "stream_dedup": f"""
    SELECT event_id, ts, user_id, event_type, {cut('value')} FROM events""",
}

FINAL |= {
    "payload_records": FINAL["forecast_payload"],
    "newest_stored_snapshot": FINAL["history_snapshot"],
    "appended_deviations": FINAL["deviation_history"],
}
ORACLES = {name: compose(sql, {**EXTRA, **RIDGE}) for name, sql in FINAL.items()}
