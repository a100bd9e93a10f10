"""The training and scoring matrix: one row per series, origin slot and horizon."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.calendar import SLOT_MINUTES, add_minutes, ntz
from slotcast.operators.blocks import KEYS
from slotcast.operators.fanout import fan_out

HORIZONS = range(4, 161)


class Bucket(NamedTuple):
    """Horizons that share a feature list; ``at_target`` are read at the target slot."""

    first: int
    last: int
    features: tuple[str, ...]
    at_target: frozenset[str]


def _bucket(first: int, last: int, features: str, at_target: str) -> Bucket:
    return Bucket(first, last, tuple(features.split()), frozenset(at_target.split()))


# Features per horizon in model order, and which of them belong to the target.
BUCKETS = [
    _bucket(
        4,
        7,
        "block_load dow year month tb load_wm3h load_wm2h ramp ramp3 dew_point temperature"
        " humidity apparent_temperature temp_mean_3h aptemp_mean_6h",
        "tb temperature apparent_temperature dew_point humidity aptemp_mean_6h temp_mean_3h dow",
    ),
    _bucket(
        8,
        19,
        "block_load dow month year tb load_wm2h load_wm3h ramp ramp1 ramp3 dew_point"
        " temperature apparent_temperature humidity wind_speed temp_mean_3h aptemp_mean_6h"
        " humidity_mean_1h",
        "tb temperature apparent_temperature dew_point aptemp_mean_6h temp_mean_3h humidity"
        " humidity_mean_1h dow wind_speed",
    ),
    _bucket(
        20,
        39,
        "block_load hour_mean load_wm3h load_wm2h dow tb tb_aptemp temperature"
        " apparent_temperature RH dew_point hour_temp aptemp_mean_3h aptemp_mean_6h"
        " temp_mean_3h temp_mean_6h humidex load_stb",
        "temperature apparent_temperature dew_point RH temp_mean_6h aptemp_mean_6h"
        " aptemp_mean_3h humidex dow tb_aptemp tb load_stb",
    ),
    _bucket(
        40,
        55,
        "block_load dow hour_mean load_wm3h load_wm2h tb tb_aptemp temperature"
        " apparent_temperature dew_point aptemp_mean_3h aptemp_mean_6h aptemp_mean_9h"
        " temp_mean_3h temp_mean_6h RH hour_temp humidex load_stb",
        "temperature apparent_temperature dew_point RH temp_mean_6h temp_mean_3h"
        " aptemp_mean_6h aptemp_mean_9h aptemp_mean_3h humidex dow tb_aptemp tb load_stb",
    ),
    _bucket(
        56,
        71,
        "block_load dow hour_mean load_wm3h load_wm2h year month tb ramp ramp1 ramp2"
        " temperature apparent_temperature dew_point aptemp_mean_3h aptemp_mean_6h"
        " aptemp_mean_9h temp_mean_3h temp_mean_6h hour_temp humidity load_stb",
        "temperature apparent_temperature dew_point temp_mean_6h temp_mean_3h aptemp_mean_6h"
        " aptemp_mean_9h aptemp_mean_3h humidity hour_temp dow tb load_stb",
    ),
    _bucket(
        72,
        95,
        "month block_load hour_mean load_wm3h load_wm2h dow tb tb_aptemp temperature"
        " apparent_temperature dew_point hour_temp aptemp_mean_12h aptemp_mean_3h"
        " aptemp_mean_6h temp_mean_3h humidex load_stb",
        "temperature apparent_temperature dew_point aptemp_mean_6h aptemp_mean_12h"
        " aptemp_mean_3h humidex dow tb_aptemp tb load_stb",
    ),
    _bucket(
        96,
        119,
        "month block_load hour_mean load_wm3h load_wm2h dow tb tb_aptemp temperature"
        " apparent_temperature dew_point hour_temp aptemp_mean_12h aptemp_mean_3h"
        " aptemp_mean_6h temp_mean_3h humidex",
        "temperature apparent_temperature dew_point aptemp_mean_6h aptemp_mean_12h"
        " aptemp_mean_3h humidex dow tb_aptemp tb",
    ),
    _bucket(
        120,
        160,
        "month block_load hour_mean load_wm3h load_wm2h dow tb tb_aptemp temperature"
        " apparent_temperature dew_point hour_temp aptemp_mean_3h aptemp_mean_12h"
        " aptemp_mean_6h temp_mean_3h humidex",
        "temperature apparent_temperature dew_point aptemp_mean_6h aptemp_mean_12h"
        " aptemp_mean_3h humidex dow tb_aptemp tb",
    ),
]

FEATURES = sorted({name for bucket in BUCKETS for name in bucket.features})


def bucket_of(horizon: int) -> Bucket:
    for bucket in BUCKETS:
        if bucket.first <= horizon <= bucket.last:
            return bucket
    raise ValueError(f"no feature list for horizon {horizon}")


def bucket_matrix(
    frame: DataFrame,
    bucket: Bucket,
    horizons: Sequence[int],
    with_target: bool = True,
    before: str | None = None,
    after: str | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Complete rows of one bucket: its features in model order, then the target."""
    at_origin = [n for n in bucket.features if n not in bucket.at_target and n != "ramp"]
    # Conditions on the origin apply before its rows multiply.
    conditions = [f"{name} is not null" for name in at_origin]
    # The scan skips slots that no kept origin looks at.
    reach = max(horizons) * SLOT_MINUTES
    if before is not None:
        conditions.append(f"datetime < timestamp_ntz'{before}'")
        frame = frame.filter(F.col("datetime") < add_minutes(ntz(before), reach))
    if after is not None:
        conditions.append(f"datetime >= timestamp_ntz'{after}'")
        frame = frame.filter(F.col("datetime") >= add_minutes(ntz(after), -reach))
    wanted = bucket.at_target | ({"block_load"} if with_target else set())
    long = fan_out(
        frame,
        horizons,
        at_origin,
        sorted(wanted),
        past="block_load" if "ramp" in bucket.features else None,
        keep=" and ".join(conditions),
        needed=sorted(wanted),
        keys=keys,
    )

    def feature(name: str) -> str:
        if name == "ramp":
            return "block_load - past as ramp"
        return f"target.{name} as {name}" if name in bucket.at_target else name

    target = ["target.block_load as target"] if with_target else []
    rows = long.selectExpr(
        *keys, "datetime", "horizon", *[feature(n) for n in bucket.features], *target
    )
    # Origin and target are complete by now; only the past value can still be missing.
    return rows.dropna("any", subset=["ramp"]) if "ramp" in bucket.features else rows


def horizon_matrix(
    frame: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    with_target: bool = True,
    before: str | None = None,
    after: str | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Complete rows of every horizon.

    Columns: keys, ``datetime`` (origin), ``horizon``, every feature (null where the
    horizon does not use it) and, for training, ``target``. ``before`` cuts training
    origins; ``after`` keeps recent origins for scoring.

    The frame is read once per bucket, each time with that bucket's columns only, so it
    should be a stored table.
    """
    parts = []
    for bucket in BUCKETS:
        own = [h for h in horizons if bucket.first <= h <= bucket.last]
        if own:
            parts.append(bucket_matrix(frame, bucket, own, with_target, before, after, keys))
    matrix = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [n for n in FEATURES if n in matrix.columns]
    target = ["target"] if with_target else []
    return matrix.select(*keys, "datetime", "horizon", *names, *target)


def rows_for(matrix: DataFrame, horizon: int) -> DataFrame:
    """One horizon's rows with its features in model order."""
    names = bucket_of(horizon).features
    extra = [c for c in ("target",) if c in matrix.columns]
    return matrix.filter(F.col("horizon") == horizon).select(
        *KEYS, "datetime", "horizon", *names, *extra
    )


def line_fit(matrix: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Least-squares line of the target on ``load_stb``, all horizons in one aggregation."""
    usable = matrix.filter(F.col("load_stb").isNotNull() & F.col("target").isNotNull())
    return usable.groupBy(*keys, "horizon").agg(
        F.regr_slope("target", "load_stb").alias("slope"),
        F.regr_intercept("target", "load_stb").alias("intercept"),
        F.regr_count("target", "load_stb").alias("n"),
    )
