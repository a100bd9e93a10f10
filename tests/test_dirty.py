from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from series_vectors import START

from slotcast.operators import dirty
from slotcast.operators.fanout import fan_out
from slotcast.operators.windows import DAY_BEFORE_LAGS, seasonal_lag_mean

LENGTH = 96


@pytest.fixture(scope="module")
def loads(series):
    draw = random.Random(1)
    return series([draw.gauss(50, 9) for _ in range(1500)]).unionByName(
        series([draw.gauss(20, 9) for _ in range(1500)], key="b")
    ).cache()


def corrected(spark, loads, slots):
    changes = spark.createDataFrame(
        [(k, START + timedelta(minutes=15 * i), 1000.0 + i) for k, i in slots],
        "series_id string, datetime timestamp_ntz, fresh double",
    )
    new = loads.join(changes, ["series_id", "datetime"], "left").select(
        "series_id", "datetime", F.coalesce("fresh", "block_load").alias("block_load")
    )
    return new, changes


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("slots", [[("a", 0)], [("a", 95), ("b", 96)], [("a", 700), ("a", 701), ("b", 1499)], []])
def test_lags_equal_a_full_rebuild(spark, loads, slots):
    new, changes = corrected(spark, loads, slots)
    stored = seasonal_lag_mean(loads)
    reach = max(DAY_BEFORE_LAGS)
    have = dirty.rebuilt(stored, new, changes, seasonal_lag_mean, back=reach, length=LENGTH)
    assert rows_of(have) == rows_of(seasonal_lag_mean(new))


def test_fan_out_equals_a_full_rebuild(spark, loads):
    new, changes = corrected(spark, loads, [("a", 400), ("b", 10)])

    def build(frame):
        return fan_out(frame, [4, 40, 160], ["block_load"], ["block_load"], past="block_load", needed=["block_load"])

    have = dirty.rebuilt(build(loads), new, changes, build, back=160, ahead=160, length=LENGTH)
    assert rows_of(have) == rows_of(build(new))


def test_rows_read_grow_with_the_corrections(spark, loads):
    seen = []

    def build(frame):
        seen.append(frame.count())
        return seasonal_lag_mean(frame)

    for slots in ([("a", 500)], [("a", 500), ("b", 900)]):
        new, changes = corrected(spark, loads, slots)
        dirty.rebuilt(seasonal_lag_mean(loads), new, changes, build, back=97, length=LENGTH).count()
    # slot 500 is number 20 of its block: its own block and the next are dirty, two more are read
    blocks = dirty.dirty_blocks(corrected(spark, loads, [("a", 500)])[1], 97, 0, length=LENGTH)
    assert blocks.count() == 2
    assert seen[0] == 4 * LENGTH and seen[1] <= 2 * 5 * LENGTH
