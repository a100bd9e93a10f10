"""Exports in one order over all files.

Rows are cut into ranges of the whole order, by bounds sampled from all of it, so a series
with most of the rows spans as many files as its rows ask for. Files lie in folders whose
names sort like their rows; read one after the other they are the sorted table. Row numbers
come from one count per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.operators.blocks import all_partitions
from slotcast.session import staged

PART = "part"


def numbered_ranges(
    rows: DataFrame, order: Sequence[str], name: str = "row_no", ranges: int | None = None
) -> DataFrame:
    """``rows`` with the place of their range (``part``) and their number in ``order`` from 0.

    ``order`` should tell all rows apart; equal rows are numbered as they come.
    """
    if PART in rows.columns or name in rows.columns:
        raise ValueError(f"columns {PART} and {name} are added here")
    cut = rows.repartitionByRange(ranges or all_partitions(rows), *order)
    # written once: bounds drawn anew would not fit the counts
    placed = staged(cut.withColumn(PART, F.spark_partition_id()), "ranges")
    ahead = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = placed.groupBy(PART).agg(F.count("*").alias("_n"))
    offsets = counts.select(PART, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(PART).orderBy(*order)
    numbered = placed.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    joined = numbered.join(F.broadcast(offsets), PART)  # at most one row per range
    return joined.withColumn(name, F.col(name) + F.col("_before")).select(PART, *rows.columns, name)


def padded(part: Column) -> Column:
    return F.lpad(part.cast("string"), 8, "0")


def export_ordered(
    rows: DataFrame,
    path: str,
    order: Sequence[str],
    name: str = "row_no",
    ranges: int | None = None,
    form: str = "csv",
) -> None:
    """Write ``rows`` with their numbers; the folders' names keep the order of the ranges."""
    numbered = numbered_ranges(rows, order, name, ranges).withColumn(PART, padded(F.col(PART)))
    # stating the order of the files' rows keeps the writer from sorting by folder alone
    sorted_rows = numbered.repartition(F.col(PART)).sortWithinPartitions(PART, name)
    writer = sorted_rows.write.mode("overwrite").partitionBy(PART).format(form)
    if form == "csv":
        writer = writer.option("header", True)
    writer.save(path)
