from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slotcast.functions import calendar as cal
from slotcast.functions.comfort import humidex, relative_humidity
from slotcast.functions.masks import cascade_mask, exceeds, plausible_load


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(expr.alias("y")).first()["y"]


def at(spark, text):
    return spark.sql(f"select timestamp_ntz'{text}' as t")


@pytest.mark.parametrize("text, tb", [("2024-01-01 00:00:00", 1), ("2024-01-01 23:59:59", 96)])
def test_time_block(spark, text, tb):
    assert at(spark, text).select(cal.time_block(F.col("t")).alias("y")).first()["y"] == tb


def test_calendar(spark):
    row = at(spark, "2024-01-01 23:45:00").select(
        *[c.alias(n) for n, c in cal.calendar_columns(F.col("t")).items()],
        cal.clock(cal.add_minutes(F.col("t"), 15)).alias("end"),
        cal.at(F.to_date("t"), cal.clock(F.col("t"))).alias("again"),
    ).first()
    assert (row["dow"], row["hour"], row["tb"], row["doy"]) == (0, 24, 96, 1)
    assert row["end"] == "00:00:00"
    assert row["again"] == datetime(2024, 1, 1, 23, 45)


def test_season(spark):
    df = spark.range(1, 13).select(cal.season(F.col("id")).alias("s"))
    assert [r["s"] for r in df.collect()] == [1, 1, 1, 2, 2, 2, 2, 2, 2, 2, 1, 1]


@pytest.mark.parametrize(
    "month, load, kept",
    [(1, 419.9, False), (1, 420.0, True), (5, 999.0, False), (4, 999.0, True), (10, 999.0, True), (9, 1000.0, True)],
)
def test_load_masks(spark, month, load, kept):
    df = at(spark, f"2024-{month:02d}-15 00:00:00").withColumn("x", F.lit(load))
    got = df.select(plausible_load(F.col("x"), F.col("t")).alias("y")).first()["y"]
    assert got == (load if kept else None)


def test_null_load_is_not_below_the_floor(spark):
    df = at(spark, "2024-06-01 00:00:00").withColumn("x", F.lit(None).cast("double"))
    assert df.select(plausible_load(F.col("x"), F.col("t")).alias("y")).first()["y"] is None


def test_cascade(spark):
    df = spark.createDataFrame(
        [(1.9, 5.0, 7.0), (2.0, 5.0, 7.0), (None, 5.0, 7.0)],
        "temperature double, dew_point double, wind_speed double",
    )
    got = [tuple(r) for r in cascade_mask(df, 2.0, ["dew_point"]).collect()]
    assert got == [(None, None, 7.0), (2.0, 5.0, 7.0), (None, None, 7.0)]


def test_flag(spark):
    df = spark.createDataFrame([(None,), (31.0,), (30.0,)], "x double")
    assert [r[0] for r in df.select(exceeds(F.col("x"), 30.0)).collect()] == [0, 1, 0]


def test_comfort(spark):
    t, td, felt = 30.0, 15.0, 33.0
    want = t + 0.555 * (6.11 * math.exp(5417.75 * (1 / 273.15 - 1 / (td + 273.15))) - 10)
    got = one(spark, humidex(F.col("t"), F.col("td")), t=t, td=td)
    assert got == pytest.approx(want, rel=1e-12)

    def e(x):
        return 6.11 * 10 ** (7.5 * x / (237.7 + x))

    rh = one(spark, relative_humidity(F.col("td"), F.col("f")), td=td, f=felt)
    assert rh == pytest.approx(100 * e(td) / e(felt), rel=1e-12)
