from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from slotcast.operators.ewm import Ewm, ewm_means, ewm_state
from slotcast.operators.interpolate import interpolate_time, known_points

SPECS = [Ewm("short", "block_load", 4), Ewm("long", "block_load", 2000)]


def same(have, want, rel):
    return have is want is None or have == pytest.approx(want, rel=rel)


@pytest.fixture(scope="module")
def frame(series):
    """Two series with holes, one of which knows nothing for long."""
    draw = random.Random(2)
    a = [None if draw.random() < 0.4 else draw.gauss(50, 20) for _ in range(4000)]
    b = [None] * 900 + [7.0, 9.0] + [None] * 2600 + [3.0] * 10 + [None] * 488
    c = [None] * 3990 + [1.0] * 10
    return series(a).unionByName(series(b, key="b")).unionByName(series(c, key="c")).cache()


def cut(frame, *places):
    numbered = frame.withColumn("at", (F.unix_micros(F.col("datetime").cast("timestamp")) / 900e6) - 1704067200 / 900)
    edges = [0, *places, 10_000]
    return [numbered.where((F.col("at") >= a) & (F.col("at") < b)).drop("at") for a, b in zip(edges, edges[1:])]


@pytest.mark.parametrize("places", [(1000, 3500), (960, 1920), (905, 906), (3, 3993)])
def test_resumed_runs_equal_the_full_one(spark, frame, places):
    first, second, recent = cut(frame, *places)
    state = ewm_state(second, SPECS, before=ewm_state(first, SPECS))
    points = known_points(second, ["block_load"], before=known_points(first, ["block_load"]))
    means = ewm_means(frame, SPECS)
    filled = interpolate_time(frame, ["block_load"])
    want = {(r.series_id, r.datetime): r for r in means.collect()}
    level = {(r.series_id, r.datetime): r.block_load for r in filled.collect()}
    have = ewm_means(recent, SPECS, state=state).collect()
    assert len(have) == recent.count() > 0
    for r in have:
        for name in ("short", "long"):
            assert same(r[name], want[r.series_id, r.datetime][name], 1e-9)
    for r in interpolate_time(recent, ["block_load"], state=points).collect():
        assert same(r.block_load, level[r.series_id, r.datetime], 1e-12)


def test_a_state_is_one_row_a_series_and_new_series_have_none(spark, frame):
    first, _, recent = cut(frame, 1000, 3500)
    state = ewm_state(first.where("series_id <> 'a'"), SPECS)
    assert state.count() == 2
    have = ewm_means(recent, SPECS, state=state)
    alone = ewm_means(recent.where("series_id = 'a'"), SPECS)
    want = {r.datetime: r.long for r in alone.collect()}
    for r in have.where("series_id = 'a'").collect():
        assert same(r.long, want[r.datetime], 1e-12)
    assert state.where("series_id = 'c'").first().short_sum is None
