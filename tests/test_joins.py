from __future__ import annotations

from slotcast.operators.grid import as_frequency, resample_mean
from slotcast.operators.interpolate import upsample
from slotcast.plans.accuracy import scored_pairs


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_no_table_with_a_row_per_slot_is_broadcast(spark, series):
    loads = series([1, None, 3, 4])
    readings = loads.toDF("series_id", "ts", "mw")
    forecasts = spark.sql(
        "select 'a' series_id, date'2024-01-01' date, '00:15:00' start_time, 1d forecast, 4 horizon,"
        " 1 revision_no, 'v9' version, timestamp_ntz'2024-01-01 00:00:00' created_at"
    )
    for joined in (
        resample_mean(readings),
        as_frequency(loads),
        scored_pairs(resample_mean(readings), forecasts, [4]),
    ):
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert "SortMergeJoin" in _plan(upsample(loads.withColumnRenamed("block_load", "x"), ["x"], minutes=5))
