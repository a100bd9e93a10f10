from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from series_vectors import START

from slotcast.operators.grid import slot_mean
from slotcast.streaming import ingest, slots

SCHEMA = "series_id string, ts timestamp_ntz, mw double"


def test_slots_close_in_order_with_their_gaps():
    held = {}
    first, begun, closed = slots.close_slots(None, False, held, [(25, 1.0), (47, None), (5, 3.0), (7, 5.0)], 20, 10)
    assert (first, begun, closed) == (20, True, [(0, 4.0), (10, None)])
    first, begun, closed = slots.close_slots(first, begun, held, [(12, 9.0), (28, 3.0)], 50, 10)
    assert (first, closed) == (50, [(20, 2.0), (30, None), (40, None)]) and held == {}
    assert slots.close_slots(50, True, held, [], 55, 10) == (50, True, [])
    first, begun, closed = slots.close_slots(None, False, held, [], 90, 10)
    assert (first, begun, closed) == (None, False, [])


def test_stream_equals_the_batch_over_closed_slots(spark, tmp_path):
    minutes = {"a": [1, 3, 16, 95, 200, 700], "b": [40, 41], "c": [690]}
    rows = [(k, START + timedelta(minutes=m), float(m)) for k, v in minutes.items() for m in v]
    rows += [("b", START + timedelta(minutes=130), None)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    late = [("a", START + timedelta(minutes=30), 1000.0)]  # its slot has gone out by then
    early = [r for r in rows if r[1] <= START + timedelta(minutes=200)]
    rest = [r for r in rows if r not in early]
    for part in (early, rest, late, [("c", START + timedelta(minutes=720), 1.0)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        readings = ingest.read_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)
        query = ingest.drain(slots.stream_dense_slots(readings), out, str(tmp_path / "state"))
        query.awaitTermination()
    have = spark.read.parquet(out)
    limit = F.lit(START + timedelta(minutes=720 - 60 - 15)).cast("timestamp_ntz")
    timed = spark.createDataFrame(rows, SCHEMA)
    last = timed.groupBy("series_id").agg(F.min("ts").alias("from"))
    want = slot_mean(timed)
    got = {(r.series_id, r.datetime): r.block_load for r in have.collect()}
    assert len(got) == have.count()
    for r in want.where(F.col("datetime") <= limit).collect():
        assert got[r.series_id, r.datetime] == r.block_load
    for r in last.collect():
        mine = sorted(t for k, t in got if k == r.series_id)
        if mine:
            steps = {b - a for a, b in zip(mine, mine[1:])}
            assert steps <= {timedelta(minutes=15)} and mine[-1] == START + timedelta(minutes=645)
            assert mine[0] <= r["from"] < mine[0] + timedelta(minutes=15)
    assert sum(v is None for v in got.values()) > 60
