from __future__ import annotations

import csv
import glob

import pytest
from pyspark.sql import functions as F

from slotcast.sinks import ordered


def lines(path):
    out = []
    for folder in sorted(glob.glob(f"{path}/part=*")):
        for file in sorted(glob.glob(f"{folder}/*.csv")):
            with open(file, newline="") as f:
                out += [(r["series_id"], int(r["at"]), int(r["row_no"])) for r in csv.DictReader(f)]
    return out


def test_files_in_a_row_are_the_sorted_table(spark, tmp_path):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("series_id"),
        ((F.col("id") * 7919) % 5000).alias("at"),
    ).repartition(5)
    path = str(tmp_path / "out")
    ordered.export_ordered(rows, path, ["series_id", "at"], ranges=9)
    have = lines(path)
    want = sorted((r.series_id, r.at) for r in rows.collect())
    assert [x[:2] for x in have] == want and [x[2] for x in have] == list(range(5000))
    folders = glob.glob(f"{path}/part=*")
    assert len(folders) == 9
    assert sum("hot" in open(f).read() for d in folders for f in glob.glob(f"{d}/*.csv")) >= 6


def test_descending_nulls_ties_empty_and_clashes(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("a", 2), ("a", 2), ("b", 1)], "series_id string, at int")
    numbered = ordered.numbered_ranges(rows, ["at", "series_id"], ranges=3)
    assert sorted((r.row_no, r.at) for r in numbered.collect()) == [(0, None), (1, 1), (2, 2), (3, 2)]
    assert ordered.numbered_ranges(rows.limit(0), ["at"]).count() == 0
    ordered.export_ordered(rows.limit(0), str(tmp_path / "none"), ["at"])
    with pytest.raises(ValueError, match="added here"):
        ordered.numbered_ranges(rows.withColumn("part", F.lit(1)), ["at"])
