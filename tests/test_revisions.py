"""Derived revisions: the time of an origin is looked up, and right where rows are missing."""

from __future__ import annotations

import os
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from slotcast.plans import deviation
from slotcast.registry.queries import REGISTRY
from slotcast.session import shared_dir
from slotcast.sources import views as v


def test_no_interval_arithmetic_per_horizon(spark, sf_dir):
    plan = REGISTRY["latest_revisions"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    reckoned = re.findall(r"\S+ \S+ \+ -_since", plan)
    assert reckoned and all(found.startswith("else ") for found in reckoned)


def test_created_at_follows_the_clock_not_the_rows(spark, tmp_path):
    start = datetime(2024, 1, 1)
    times = [start + timedelta(hours=7 * i) for i in range(100)]
    # two slots after the month's grid, with a gap before each
    times += [datetime(2024, 2, 2, 3, 30), datetime(2024, 2, 5, 12)]
    rows = [(i, t, i % 2 * 25, "view", float(i), "") for i, t in enumerate(times)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    made = v.forecast_revisions(spark, str(tmp_path))
    target = F.to_timestamp_ntz(F.concat_ws(" ", F.col("date").cast("string"), "start_time"))
    made = made.withColumn("target", target).persist()
    assert made.where("target >= timestamp_ntz'2024-02-01 00:00:00'").count() == 2 * 157
    late = "created_at is null or created_at != target - make_dt_interval(0, 0, horizon * 15 - 1)"
    assert made.where(late).isEmpty()
    made.unpersist()


def test_history_packs_a_revision_and_stores_none(spark, sf_dir):
    changes = REGISTRY["deviation_history"](spark, sf_dir)
    changes.collect()
    plan = changes._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    placed = re.findall(r"(?<!, )Exchange hashpartitioning\(series_id#\d+, _day#\d+, \d+\), REPARTITION", plan)
    assert len(placed) == 1 and "places-" not in plan
    assert not re.findall(r"Join \[[^]]*start_time", plan)


def test_history_of_odd_revisions_equals_brute_force(spark):
    start = datetime(2024, 1, 1)
    rows = []
    for key, made in (("a", start), ("a", start + timedelta(hours=1)), ("a", start + timedelta(days=3)), ("b", start),
                      ("a", None), (None, start), (None, start + timedelta(hours=1))):
        for h in range(1, 24):
            # two rows of one slot, a slot without a time, and a revision with few rows
            clock = None if h == 5 else f"{min(h, 21) // 2:02d}:00:00"
            if made and made.day == 4 and h > 6:
                continue
            value = h * 10.0 + (made or start).hour + (made or start).day
            rows.append((key, start.date(), clock, "x", value, h, "v9", made, h))
    schema = (
        "series_id string, date date, start_time string, end_time string, forecast double, horizon int,"
        " version string, created_at timestamp_ntz, revision_no int"
    )
    heads = {}
    for r in rows:
        if r[0] and r[7]:
            heads.setdefault((r[0], r[7]), []).append(r)
    heads = {k: sorted(v, key=lambda r: r[5])[:18] for k, v in heads.items()}
    want = []
    for (key, made), head in heads.items():
        older = max((m for k, m in heads if k == key and m < made), default=None)
        for r in head[:17] if older else []:
            want += [
                (key, made, r[2], r[8], o[4], r[4]) for o in heads[key, older][1:] if r[2] and r[1:4] == o[1:4]
            ]
    got = deviation.deviation_history(spark.createDataFrame(rows, schema).repartition(5))
    columns = ["series_id", "created_at", "start_time", "revision_no", "previous_revision_forecast"]
    have = got.select(*columns, "current_revision_forecast").collect()
    assert sorted(tuple(r) for r in have) == sorted(want) and len(want) > 30


def test_appended_changes_are_stored_once(spark, sf_dir):
    before = set(os.listdir(shared_dir(spark)))
    assert REGISTRY["appended_deviations"](spark, sf_dir).count() > 0
    left = set(os.listdir(shared_dir(spark))) - before
    assert {name.split("-")[0] for name in left} == {"deviations"}
