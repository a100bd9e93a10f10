"""Slot means over a stream with a row for every slot, also for those without readings.

A windowed aggregate emits a slot only if a reading fell into it. Here each series keeps the
slots that the watermark has not passed, and a timer on the first of them. When the
watermark passes slots, by readings or by the timer, all of them are emitted in order, the
empty ones with a null. What a series keeps is bounded by the watermark's delay, not by its
history. A reading of a slot that was emitted already comes too late and is left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from slotcast.operators.blocks import KEYS

from .ingest import LATENESS

#: First slot not emitted yet, and the sums and counts of the slots that are open, as JSON.
STATE = "first long, begun boolean, held string"


def close_slots(
    first: int | None,
    begun: bool,
    held: dict[int, list],
    readings: list[tuple[int, float | None]],
    watermark: int,
    width: int,
) -> tuple[int | None, bool, list[tuple[int, float | None]]]:
    """First open slot, whether any was emitted, and the (slot, mean) pairs now passed.

    Times are whole milliseconds. ``held`` maps open slots to sum and count, and is changed.
    """
    for at, value in readings:
        slot = at - at % width
        if begun and slot < first:
            continue
        first = slot if first is None else min(first, slot)
        total = held.setdefault(slot, [0.0, 0])
        if value is not None:
            total[0] += value
            total[1] += 1
    closed = []
    while first is not None and first + width <= watermark:
        total, n = held.pop(first, (0.0, 0))
        closed.append((first, total / n if n else None))
        first += width
    return first, begun or bool(closed), closed


def stream_dense_slots(
    readings: DataFrame,
    lateness: str = LATENESS,
    minutes: int = 15,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """(keys, datetime, block_load) of every slot from a series' first to the last one passed.

    ``readings`` has the keys, ``ts`` and ``mw``.
    """
    width = minutes * 60_000
    names = list(keys)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, begun, held = None, False, {}
        if state.exists:
            first, begun, packed = state.get
            held = {int(k): v for k, v in json.loads(packed).items()}
        watermark = state.getCurrentWatermarkMs()
        found = []
        if not state.hasTimedOut:
            for part in parts:
                found += [
                    (int(at), None if value is None or value != value else float(value))
                    for at, value in zip(part["at"], part["mw"], strict=True)
                ]
        first, begun, closed = close_slots(first, begun, held, found, watermark, width)
        if first is not None:
            state.update((first, begun, json.dumps(held)))
            state.setTimeoutTimestamp(max(first + width - 1, watermark + 1))
        yield pd.DataFrame(
            {
                **{name: [value] * len(closed) for name, value in zip(names, key, strict=True)},
                "at": [slot for slot, _ in closed],
                "block_load": pd.Series([mean for _, mean in closed], dtype="float64"),
            }
        )

    timed = readings.select(*names, F.col("ts").cast("timestamp").alias("ts"), "mw").withWatermark("ts", lateness)
    kinds = {f.name: f.dataType for f in readings.schema}
    out = T.StructType(
        [T.StructField(n, kinds[n]) for n in names]
        + [T.StructField("at", T.LongType()), T.StructField("block_load", T.DoubleType())]
    )
    slots = (
        timed.withColumn("at", F.unix_millis("ts"))
        .groupBy(*names)
        .applyInPandasWithState(step, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    return slots.select(
        *names,
        F.timestamp_millis("at").cast("timestamp_ntz").alias("datetime"),
        F.when(~F.isnan("block_load"), F.col("block_load")).alias("block_load"),
    )
