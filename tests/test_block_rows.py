from __future__ import annotations

from slotcast.operators.fanout import fan_out
from slotcast.plans.deviation import deviation_history
from slotcast.sources import views as v


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_horizons_need_no_window_each(series):
    frame = series([float(i) for i in range(400)])
    out = fan_out(frame, range(4, 161), ["block_load"], ["block_load"], past="block_load", needed=["block_load"])
    assert "lead(" not in _plan(out) and "lag(" not in _plan(out)
    rows = {(r["datetime"], r["horizon"]): r for r in out.collect()}
    assert len(rows) == sum(400 - h for h in range(4, 161))
    assert all(r["target"]["block_load"] == r["block_load"] + h for (_, h), r in rows.items())
    assert all(r["past"] == (r["block_load"] - h if r["block_load"] >= h else None) for (_, h), r in rows.items())


def test_revisions_need_no_window_each(spark, sf_dir):
    assert "lag(" not in _plan(v.forecast_revisions(spark, sf_dir))


def test_history_of_changes_reads_the_forecasts_once(spark):
    rows = spark.sql(
        "select 'a' series_id, date'2024-01-01' date, lpad(string(r + h), 8, '0') start_time,"
        " lpad(string(r + h + 1), 8, '0') end_time, double(r * 100) forecast, int(h) horizon, 'v9' version,"
        " if(r = 9, null, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(15 * r))) created_at,"
        " int(r) revision_no from (select explode(array(1, 2, 3, 9)) r) join (select explode(sequence(4, 40)) h)"
    )
    changes = deviation_history(rows)
    assert all("places" in path for path in changes.inputFiles())
    assert changes.count() == 2 * 17
    assert {r[0] for r in changes.select("deviation").distinct().collect()} == {100.0}
