"""Interpolation keeps time and value of the nearest known points apart, row by row."""

from __future__ import annotations

import re

from slotcast.operators.interpolate import interpolate_time


def test_no_struct_per_row(series):
    filled = interpolate_time(series([None, 1, None, None, 4, None], minutes=60), ["block_load"])
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and not re.search(r"struct\(t, _t#", plan)
    rows = [row.block_load for row in filled.orderBy("datetime").collect()]
    assert rows == [None, 1, 2, 3, 4, 4]
