"""Words, keys and small-side joins shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.session import scratch_path, staged

#: A word is a maximal run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: A side with at most this many rows may be broadcast; a larger one is shuffled.
SMALL_ROWS = 100_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def fresh(name: str, taken: Sequence[str]) -> str:
    """A column name like ``name`` that clashes with none of ``taken``."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def join_small(
    df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner", limit: int = SMALL_ROWS
) -> DataFrame:
    """Null-safe join with a stored side; it is broadcast only if its row count allows.

    ``side`` must be cheap to count (a written table). Beyond ``limit`` rows Spark joins
    by shuffling, and splits hot keys at run time.
    """
    rows = side.limit(limit + 1).count()
    names = {c: fresh(f"_side_{c}", df.columns) for c in on}
    right = side.withColumnsRenamed(names)
    if rows <= limit:
        right = F.broadcast(right)
    test = None
    for c, name in names.items():
        same = F.col(c).eqNullSafe(F.col(name))
        test = same if test is None else test & same
    return df.join(right, test, how).drop(*names.values())


def stored(df: DataFrame, name: str, by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Like ``staged``, with the folder, for a table that ``discard`` deletes once it is used up."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders of the shared folder that no later step reads."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(hadoop).delete(place, True)


__all__ = [
    "SMALL_ROWS", "WORD", "discard", "fresh", "join_small", "read", "staged", "stored", "words_of",
]
