"""Slot means, deduplication and upserts over a stream of readings.

A watermark needs an instant, so naive times are read as instants of the session's
time zone and turned back into naive times behind the stateful step. Run these with the
session time zone set to UTC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slotcast.operators.blocks import KEYS
from slotcast.sinks.tables import FORECAST_KEY, upsert

LATENESS = "1 hour"


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet"
) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(folder)


def stream_slot_mean(
    readings: DataFrame,
    lateness: str = LATENESS,
    minutes: int = 15,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Mean per slot, emitted once no reading that is late by ``lateness`` can change it."""
    timed = readings.withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        timed.withWatermark("ts", lateness)
        .groupBy(F.window("ts", f"{minutes} minutes").alias("_w"), *keys)
        .agg(F.avg("mw").alias("block_load"))
        .select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("datetime"), "block_load")
    )


def stream_dedup(
    readings: DataFrame, keys: Sequence[str], lateness: str = LATENESS
) -> DataFrame:
    """First arrival per reading key; state older than the watermark is dropped."""
    timed = readings.withColumn("ts", F.col("ts").cast("timestamp"))
    unique = timed.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(list(keys))
    return unique.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is new since the checkpoint, append it to a Parquet table, stop.

    A run that finds nothing new starts no batch: the checkpoint is the gate.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert_batches(
    path: str, keys: Sequence[str] = FORECAST_KEY, **options
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function; a repeated batch leaves the table unchanged."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch, path, keys, **options)

    return write


def drain_upserts(records: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Upsert what is new since the checkpoint into a forecast table, stop."""
    return (
        records.writeStream.foreachBatch(upsert_batches(path, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
