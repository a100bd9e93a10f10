from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from series_vectors import START
from slotcast.operators.grid import fixed_grid, own_grid
from slotcast.plans import boosting, load, matrix, models
from slotcast.registry import queries


class Stub:
    """Stands in for a regressor: 'fits' and stores a file, or fails."""

    def __init__(self, horizon):
        self.horizon = horizon

    def fit(self, rows):
        if self.horizon in (5, 40):
            raise ValueError("no rows")
        return self

    def write(self):
        return self

    overwrite = write

    def save(self, path):
        os.makedirs(path)


def test_failed_horizons_lose_no_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "regressor", lambda horizon, rounds, depth: Stub(horizon))
    monkeypatch.setattr(models, "rows_for", lambda frame, horizon: frame)
    with pytest.raises(RuntimeError, match="2 of 157 horizons failed: horizon 5: no rows; horizon 40"):
        models.train_models(spark.range(1), matrix.HORIZONS, str(tmp_path))
    stored = {int(p.split("=")[1]) for p in os.listdir(tmp_path)}
    assert stored == set(range(4, 161)) - {5, 40}


@pytest.mark.parametrize(
    "horizon,step,depth,rounds",
    [
        (4, 0.1, 8, 1000),
        (8, 0.1, 7, 1200),
        (20, 0.7, 5, 1000),
        (40, 0.3, 10, 1000),
        (56, 0.02, 8, 700),
        (72, 0.015, 10, 900),
        (120, 0.1, 6, 1300),
        (160, 0.1, 6, 800),
    ],
)
def test_default_settings(spark, horizon, step, depth, rounds):
    trees = models.regressor(horizon).getStages()[1]
    assert (trees.getStepSize(), trees.getMaxDepth(), trees.getMaxIter()) == (step, depth, rounds)
    assert models.regressor(horizon, rounds=3).getStages()[1].getMaxIter() == 3


def _rows(spark, rows):
    return spark.createDataFrame(rows, "series_id string, datetime timestamp_ntz, block_load double")


def test_corrections_replace_and_keep_slots_unique(spark):
    slots = [START + timedelta(minutes=15 * i) for i in range(96)]
    history = _rows(spark, [("a", s, float(i)) for i, s in enumerate(slots)])
    fresh = _rows(
        spark,
        [("a", slots[40], 900.0), ("a", slots[40], 800.0), ("a", slots[41] + timedelta(minutes=7), 1.0), ("a", slots[41], None)],
    )
    merged = load.refreshed_history(history, fresh, str(datetime(2024, 1, 3)))
    values = {r.datetime: r.block_load for r in merged.collect()}
    assert merged.count() == len(values) == 96
    assert (values[slots[40]], values[slots[41]], values[slots[42]]) == (900.0, 1.0, 42.0)

    # a lag or target counts rows, so it stays where it was: 09:15 still looks at 10:15
    grid = fixed_grid(merged, str(slots[0]), str(slots[-1]))
    on_grid = {r.datetime: r.block_load for r in load.on_grid(merged, grid).collect()}
    assert len(on_grid) == 96 and sorted(on_grid)[37 + 4] == slots[41]
    doubled = load.on_grid(history.unionByName(fresh), grid)
    assert doubled.count() == 96


def test_grids_use_all_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        series = spark.range(2000).select(F.concat(F.lit("s"), "id").alias("series_id"))
        ends = series.select("series_id", F.explode(F.array(
            *[F.lit(str(t)).cast("timestamp_ntz") for t in (START, START + timedelta(days=2))])).alias("datetime"))
        for grid, slots in ((fixed_grid(series, "2024-01-01 00:00:00", "2024-01-02 23:45:00"), 192), (own_grid(ends), 193)):
            used = grid.groupBy(F.spark_partition_id()).count().collect()
            assert len(used) == 64 and sum(r[1] for r in used) == 2000 * slots
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_gbt_forecast_trains_all_horizons_with_the_settings_of_the_table(spark, sf_dir, monkeypatch):
    asked, every = {}, list(range(4, 161))
    build, forecast = matrix.horizon_matrix, boosting.forecast

    def horizon_matrix(frame, horizons=matrix.HORIZONS, **options):
        asked.setdefault("matrix", []).append(list(horizons))
        return build(frame, horizons, **options)

    def train(rows, by=("series_id",), growth=boosting.GROWTH, rounds=None, seed=42):
        asked.update(by=tuple(by), growth=growth, rounds=rounds)
        return spark.createDataFrame([], "series_id string, horizon int, base double, trees array<struct<splits:array<struct<feature:int,reach:double>>,leaves:array<double>>>")

    monkeypatch.setattr(queries, "staged", lambda df, *a: df)
    monkeypatch.setattr(matrix, "horizon_matrix", horizon_matrix)
    monkeypatch.setattr(boosting, "train", train)
    monkeypatch.setattr(boosting, "forecast", forecast)
    queries.REGISTRY["gbt_forecast_2_rounds"](spark, sf_dir)
    assert asked == {"matrix": [every, every], "by": ("series_id",), "growth": boosting.GROWTH, "rounds": 2}


def test_settings_cover_every_horizon_once():
    for h in matrix.HORIZONS:
        assert sum(g.first <= h <= g.last for g in boosting.GROWTH) == 1
        old = models.boosting_of(h)
        new = next(g for g in boosting.GROWTH if g.first <= h <= g.last)
        assert (old.step, old.depth, old.rounds) == (new.step, new.depth, new.rounds)
    assert [g.l2 for g in boosting.GROWTH] == [0.5, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0, 0.1]
    assert [g.temperature for g in boosting.GROWTH] == [1.0, 1.0, 1.0, 1.0, 1.0, 0.8, 1.0, 1.0]
