"""DuckDB SQL for the registered queries, written from the definitions.

Each oracle is a chain of named sub-queries over the stored tables. Reals are cut to
four digits with a cut-off off the half-way point, as in ``queries.py``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from slotcast.plans.accuracy import HORIZONS as SCORED, VERSION
from slotcast.plans.features import LOAD_MEANS, WEATHER_MEANS
from slotcast.plans.matrix import BUCKETS, FEATURES
from slotcast.schema import WEATHER_COLUMNS
from slotcast.sources import views as v

CUT = 0.4863


def cut(expr: str, name: str | None = None) -> str:
    return f"floor(({expr}) * 10000 + {CUT}) / 10000 AS {name or expr}"


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def _list(names: Iterable[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


def interpolated(source: str, columns: Sequence[str], keep: Sequence[str] = ()) -> str:
    """Linear in elapsed time; trailing nulls hold the last value."""
    near, values = [], []
    back = "OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    for c in columns:
        when = f"CASE WHEN {c} IS NOT NULL THEN epoch_us(datetime) END"
        near += [
            f"last_value({c} IGNORE NULLS) {back} AS v0_{c}",
            f"last_value({when} IGNORE NULLS) {back} AS t0_{c}",
            f"first_value({c} IGNORE NULLS) {ahead} AS v1_{c}",
            f"first_value({when} IGNORE NULLS) {ahead} AS t1_{c}",
        ]
        share = f"(epoch_us(datetime) - t0_{c}) / CAST(t1_{c} - t0_{c} AS DOUBLE)"
        values.append(
            f"coalesce({c}, v0_{c} + (v1_{c} - v0_{c}) * ({share}), v0_{c}) AS {c}"
        )
    others = _list(["series_id", "datetime", *keep])
    return f"SELECT {others}, {', '.join(values)} FROM (SELECT *, {', '.join(near)} FROM {source})"


def regular(source: str, minutes: int, columns: Sequence[str]) -> str:
    """Grid from the first to the last row; only exact hits keep their values."""
    step = f"INTERVAL '{minutes} minutes'"
    return f"""
    SELECT g.series_id, g.datetime, {_list(columns, 's.')}
    FROM (
        SELECT series_id, unnest(generate_series(
            time_bucket({step}, min(datetime)), time_bucket({step}, max(datetime)), {step}
        )) AS datetime
        FROM {source} GROUP BY series_id
    ) g LEFT JOIN {source} s ON s.series_id = g.series_id AND s.datetime = g.datetime"""


def filled(source: str, columns: Sequence[str]) -> str:
    w = "OVER (PARTITION BY series_id ORDER BY datetime)"
    values = [f"coalesce({c}, lag({c}) {w}, lead({c}) {w}) AS {c}" for c in columns]
    return f"SELECT series_id, datetime, {', '.join(values)} FROM {source}"


def upsampled(name: str, source: str, minutes: int = 15) -> dict[str, str]:
    columns = WEATHER_COLUMNS
    steps = {
        f"{name}_1": interpolated(source, columns),
        f"{name}_2": regular(f"{name}_1", minutes, columns),
    }
    last = f"{name}_2"
    if minutes == 15:
        last = f"{name}_3"
        steps[last] = filled(f"{name}_2", columns)
    steps[name] = interpolated(last, columns)
    return steps


def cascaded(source: str, floor: float, dependents: Sequence[str]) -> str:
    def value(c: str) -> str:
        if c != "temperature" and c not in dependents:
            return c
        return f"CASE WHEN temperature >= {floor} THEN {c} END AS {c}"

    return f"SELECT series_id, datetime, {', '.join(value(c) for c in WEATHER_COLUMNS)} FROM {source}"


def weighted(source: str, means) -> str:
    """The definition itself: every earlier known value with its weight."""
    sums = []
    for m in means:
        weight = f"pow({m.decay!r}, a.i - b.i)"
        known = f"FILTER (WHERE b.{m.column} IS NOT NULL)"
        sums.append(
            f"sum(b.{m.column} * {weight}) {known} / nullif(sum({weight}) {known}, 0) AS {m.name}"
        )
    columns = sorted({m.column for m in means})
    numbered = f"(SELECT series_id, datetime, epoch(datetime) // 900 AS i, {_list(columns)} FROM {source})"
    return f"""
    SELECT a.series_id, a.datetime, {', '.join(sums)}
    FROM {numbered} a JOIN {numbered} b ON a.series_id = b.series_id AND b.i <= a.i
    GROUP BY a.series_id, a.datetime"""


CALENDAR = """CAST(datetime AS DATE) AS date,
    CAST((hour(datetime) * 60 + minute(datetime)) // 15 + 1 AS INTEGER) AS tb,
    CAST(hour(datetime) + 1 AS INTEGER) AS hour,
    CAST(isodow(datetime) - 1 AS INTEGER) AS dow,
    CAST(dayofyear(datetime) AS INTEGER) AS doy,
    CAST(month(datetime) AS INTEGER) AS month,
    CAST(year(datetime) AS INTEGER) AS year"""
CALENDAR_NAMES = ["date", "tb", "hour", "dow", "doy", "month", "year"]
TB = "CAST((hour({0}) * 60 + minute({0})) // 15 + 1 AS INTEGER)"

HUMIDEX = (
    "temperature + 0.555 * (6.11 * exp(5417.75 * (1 / 273.15 - 1 / (dew_point + 273.15))) - 10)"
)
RH = (
    "100 * (6.11 * pow(10, 7.5 * dew_point / (237.7 + dew_point)))"
    " / (6.11 * pow(10, 7.5 * apparent_temperature / (237.7 + apparent_temperature)))"
)


def _mean_without(kind: str) -> str:
    return f"avg(CASE WHEN event_type <> '{kind}' THEN mw END)"


def _in_season(load: str, floor: float, warm_floor: float) -> str:
    return (
        f"CASE WHEN {load} < {floor} THEN NULL"
        f" WHEN {load} < {warm_floor} AND month(datetime) BETWEEN 5 AND 9 THEN NULL"
        f" ELSE {load} END"
    )


def _clean(source: str, floor: float = v.LOAD_FLOOR, warm_floor: float = v.LOAD_FLOOR) -> str:
    return (
        f"SELECT series_id, datetime, {_in_season('block_load', floor, warm_floor)} AS block_load"
        f" FROM {source}"
    )


HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in v.HOLIDAYS)


def _stored(value: str, source: str) -> str:
    """Layout of a stored forecast; ``datetime`` is the target."""
    origin = "datetime - to_minutes(15 * horizon)"
    return f"""
    SELECT series_id, CAST(datetime AS DATE) AS date,
        strftime(datetime, '%H:%M:%S') AS start_time,
        strftime(datetime + INTERVAL '15 minutes', '%H:%M:%S') AS end_time,
        {value} AS forecast, horizon, 'v9' AS version,
        {origin} + INTERVAL '1 minute' AS created_at,
        {TB.format(f'({origin})')} AS revision_no
    FROM {source} WHERE ({value}) IS NOT NULL"""


def _lagged_origin() -> str:
    first, last = 4, 160  # stated here on its own, so that a cut in the views would show
    return f"""
    SELECT series_id, datetime, load_stb, horizon, past_loads[horizon - {first} + 1] AS origin_load
    FROM (
        SELECT series_id, datetime, load_stb,
            [{', '.join(f'lag(block_load, {h}) OVER s' for h in range(first, last + 1))}] AS past_loads
        FROM targets WINDOW s AS (PARTITION BY series_id ORDER BY datetime)
    ), (SELECT CAST(unnest(range({first}, {last + 1})) AS INTEGER) AS horizon)"""


def _rolling(source: str, partition: str, order: str) -> str:
    parts = []
    for n in (4, 12, 96):
        w = f"OVER (PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for c, name in (("mae", f"mae_{n}"), ("block_load", f"avg_load_{n}")):
            parts.append(f"CASE WHEN count({c}) {w} = {n} THEN avg({c}) {w} END AS {name}")
    return f"SELECT *, {', '.join(parts)} FROM {source}"


ACCURACY_REALS = [
    "block_load",
    "forecast",
    "mae",
    "mae_4",
    "mae_12",
    "mae_96",
    "avg_load_4",
    "avg_load_12",
    "avg_load_96",
]


def _scored(demand: str, forecasts: str) -> str:
    return f"""
    SELECT f.series_id, f.datetime, a.block_load, f.forecast, f.horizon, f.revision_no, f.version,
        abs(a.block_load - f.forecast) AS mae
    FROM (
        SELECT *, date + CAST(start_time AS TIME) AS datetime,
            row_number() OVER (
                PARTITION BY series_id, date, start_time, horizon, revision_no ORDER BY created_at
            ) AS copy
        FROM {forecasts} WHERE version = '{VERSION}' AND horizon IN ({_list(map(str, SCORED))})
    ) f JOIN {demand} a ON a.series_id = f.series_id AND a.datetime = f.datetime
    WHERE copy = 1"""


def _accuracy_layout(source: str) -> str:
    reals = ", ".join(cut(f"coalesce({c}, 0)", c) for c in ACCURACY_REALS)
    return (
        f"SELECT series_id, CAST(datetime AS DATE) AS date, strftime(datetime, '%H:%M:%S') AS time,"
        f" {reals}, horizon, version FROM {source}"
    )


def _matrix_value(name: str) -> str:
    cases = []
    for b in BUCKETS:
        if name not in b.features:
            continue
        if name == "ramp":
            value = "o.block_load - p.block_load"
        else:
            value = f"{'t' if name in b.at_target else 'o'}.{name}"
        cases.append(f"WHEN o.horizon BETWEEN {b.first} AND {b.last} THEN {value}")
    return f"CASE {' '.join(cases)} END AS {name}"


def _matrix() -> str:
    """Long form: origin, target and past slot joined on plain time columns."""
    complete = " OR ".join(
        f"(horizon BETWEEN {b.first} AND {b.last} AND "
        + " AND ".join(f"{n} IS NOT NULL" for n in b.features)
        + ")"
        for b in BUCKETS
    )
    values = ", ".join(_matrix_value(n) for n in FEATURES)
    return f"""
    SELECT * FROM (
        SELECT o.series_id, o.datetime, o.horizon, {values}, t.block_load AS target
        FROM origins o
        JOIN framed t ON t.series_id = o.series_id AND t.datetime = o.target_at
        LEFT JOIN framed p ON p.series_id = o.series_id AND p.datetime = o.past_at
    ) WHERE target IS NOT NULL AND ({complete})"""


def _steps() -> dict[str, str]:
    s: dict[str, str] = {}
    s["obs"] = """
    SELECT 's' || CAST(user_id // 25 AS VARCHAR) AS series_id, ts, value AS mw,
        CAST(user_id % 3 AS INTEGER) AS source, event_type FROM events"""
    s["slots"] = """
    SELECT series_id, time_bucket(INTERVAL '15 minutes', ts) AS datetime, avg(mw) AS block_load
    FROM obs GROUP BY ALL"""
    s["grid"] = f"""
    SELECT series_id, unnest(generate_series(
        {ts(v.FIRST_SLOT)}, {ts(v.LAST_SLOT)}, INTERVAL '15 minutes')) AS datetime
    FROM (SELECT DISTINCT series_id FROM obs)"""
    s["load_slot"] = "SELECT * FROM grid LEFT JOIN slots USING (series_id, datetime)"
    s["feed_slots"] = """
    SELECT series_id, source, time_bucket(INTERVAL '15 minutes', ts) AS datetime,
        avg(mw) AS block_load
    FROM obs GROUP BY ALL"""
    s["load_filled"] = interpolated("load_slot", ["block_load"])
    s["targets"] = """
    SELECT *, (lag(block_load, 96) OVER s + lag(block_load, 97) OVER s
        + lag(block_load, 95) OVER s) / 3 AS load_stb
    FROM load_filled WINDOW s AS (PARTITION BY series_id ORDER BY datetime)"""
    s["weather_feed"] = f"""
    SELECT * FROM (
        SELECT series_id, source AS feed, date_trunc('hour', ts) AS datetime,
            {_mean_without('view')} AS apparent_temperature,
            {_mean_without('click')} * 0.3 AS dew_point,
            {_mean_without('purchase')} / 200 AS humidity,
            {_mean_without('error')} AS temperature,
            avg(mw) / 500 AS cloud_cover, max(mw) AS wind_bearing,
            {_mean_without('signup')} / 10 AS wind_speed
        FROM obs GROUP BY ALL
    ) WHERE (feed = 0 AND datetime < {ts(v.ACTUAL_UNTIL)}) OR feed = 1
        OR (feed = 2 AND datetime >= {ts(v.FORECAST_FROM)})"""
    columns = _list(WEATHER_COLUMNS)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in WEATHER_COLUMNS)
    for i, name in enumerate(("actual", "optimised", "forecast_weather")):
        where = f"feed = {i}" + (f" AND {complete}" if i == 1 else "")
        s[name] = f"SELECT series_id, datetime, {columns} FROM weather_feed WHERE {where}"

    def merged(*sources: str) -> str:
        ranked = " UNION ALL ".join(
            f"SELECT {i} AS prio, series_id, datetime, {columns} FROM {name}"
            for i, name in enumerate(sources)
        )
        return f"""
        SELECT series_id, datetime, {columns} FROM ({ranked})
        QUALIFY row_number() OVER (PARTITION BY series_id, datetime ORDER BY prio) = 1"""

    live = ["dew_point", "apparent_temperature", "humidity"]
    all_dependents = live + ["cloud_cover", "wind_bearing", "wind_speed"]
    s["weather_merged"] = merged("actual", "optimised", "forecast_weather")
    s["observed_masked"] = cascaded("actual", 2, live)
    s |= upsampled("observed", "observed_masked")
    s["live_merged"] = merged("observed", "optimised", "forecast_weather")
    s["live_masked"] = cascaded("live_merged", 2, live)
    s |= upsampled("live_weather", "live_masked")
    s["training_merged"] = merged("actual", "forecast_weather")
    s["training_masked"] = cascaded("training_merged", 3, all_dependents)
    s |= upsampled("training_weather", "training_masked")
    s |= upsampled("weather_15", "weather_merged")
    s |= upsampled("weather_30", "weather_merged", 30)

    s["fed"] = """
    SELECT series_id, datetime, block_load FROM feed_slots
    QUALIFY row_number() OVER (PARTITION BY series_id, datetime ORDER BY source) = 1"""
    s["fed_masked"] = _clean("fed")
    s["clean_load"] = interpolated("fed_masked", ["block_load"])
    s["slots_masked"] = _clean("slots")
    s["training_load"] = f"""
    SELECT series_id, datetime, block_load
    FROM grid LEFT JOIN (
        SELECT * FROM slots_masked
        WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT unnest([{HOLIDAY_LIST}]) AS date) h
            WHERE h.date = CAST(datetime AS DATE))
    ) USING (series_id, datetime)"""

    def framed(name: str, load: str, weather: str) -> dict[str, str]:
        window = "WINDOW s AS (PARTITION BY series_id ORDER BY datetime)"
        lags = ["block_load"] + [f"lag(block_load, {k}) OVER s" for k in range(1, 5)]
        ramps = ", ".join(f"{lags[k - 1]} - {lags[k]} AS ramp{k}" for k in range(1, 5))
        weather_means = [m for m in WEATHER_MEANS]
        load_names = [f"ramp{k}" for k in range(1, 5)] + ["hour_mean"]
        return {
            f"{name}_joined": f"""
            SELECT series_id, datetime, block_load, {columns}, {CALENDAR},
                lead(apparent_temperature, 4) OVER s AS _aptemp_ahead
            FROM {load} FULL JOIN {weather} USING (series_id, datetime) {window}""",
            f"{name}_load": f"""
            SELECT series_id, datetime, {ramps},
                (lag(block_load, 96) OVER s + lag(block_load, 97) OVER s
                    + lag(block_load, 95) OVER s) / 3 AS load_stb,
                avg(block_load) OVER (
                    PARTITION BY series_id, CAST(datetime AS DATE), hour(datetime)) AS hour_mean
            FROM {load} {window}""",
            f"{name}_load_means": weighted(load, LOAD_MEANS),
            f"{name}_weather_means": weighted(f"{name}_joined", weather_means),
            name: f"""
            SELECT series_id, datetime, j.block_load, {columns}, {_list(CALENDAR_NAMES)},
                {_list(load_names)}, load_stb, {_list(m.name for m in LOAD_MEANS)},
                {_list(m.name for m in weather_means)},
                {HUMIDEX} AS humidex, {RH} AS RH, tb * apparent_temperature AS tb_aptemp,
                hour * temperature AS hour_temp
            FROM {name}_joined j
            LEFT JOIN {name}_load USING (series_id, datetime)
            LEFT JOIN {name}_load_means USING (series_id, datetime)
            LEFT JOIN {name}_weather_means USING (series_id, datetime)""",
        }

    s |= framed("framed", "training_load", "training_weather")
    s["live_load"] = """
    SELECT series_id, datetime, block_load FROM grid
    LEFT JOIN clean_load USING (series_id, datetime)"""
    s |= framed("live_framed", "live_load", "live_weather")
    s["origins"] = """
    SELECT *, datetime + to_minutes(15 * horizon) AS target_at,
        datetime - to_minutes(15 * horizon) AS past_at
    FROM framed, (SELECT CAST(unnest(range(4, 161)) AS INTEGER) AS horizon)
    WHERE block_load IS NOT NULL AND datetime < {cutoff}""".format(cutoff=ts(v.AS_OF))
    s["matrix"] = _matrix()

    s["live_targets"] = f"""
    SELECT *, CAST(unnest([{_list(map(str, v.SCORED_HORIZONS))}]) AS INTEGER) AS horizon
    FROM targets"""
    s["forecast_live"] = _stored("load_stb", "live_targets")
    s["revision_targets"] = _lagged_origin()
    s["forecast_revisions"] = _stored(
        "load_stb + 0.5 * horizon + 0.1 * origin_load", "revision_targets"
    )
    return s


STEPS = _steps()
HEAVY = {
    "obs",
    "slots",
    "load_slot",
    "load_filled",
    "weather_feed",
    "training_load",
    "training_weather",
    "framed_joined",
    "framed_load_means",
    "framed_weather_means",
    "framed",
    "origins",
    "live_merged",
    "observed",
    "live_load",
    "live_weather",
    "live_framed_joined",
    "live_framed_load_means",
    "live_framed_weather_means",
    "forecast_live",
    "forecast_revisions",
    "placed",
    "matrix",
    "apart",
    "spread",
    "solved",
}


def _needs(sql: str, known: Iterable[str]) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [name for name in known if name in words]


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` chain of exactly the steps that ``final`` reaches."""
    steps = {**STEPS, **(extra or {})}
    done: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in done:
            return
        for dependency in _needs(steps[name], steps):
            if dependency != name:
                visit(dependency)
        done[name] = steps[name]

    for name in _needs(final, steps):
        visit(name)
    chain = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in HEAVY else ''}({sql.strip()})"
        for name, sql in done.items()
    )
    return f"WITH {chain}\n{final.strip()}" if done else final.strip()
