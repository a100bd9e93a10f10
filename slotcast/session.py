"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session used by the tests and by bench.py; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("slotcast")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh scratch
    folder. On a cluster a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="slotcast-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name for one run below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


#: Paths staged by the jobs that run now, innermost last.
_JOBS: list[list[str]] = []


@contextmanager
def job_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside when the job ends, also when it fails."""
    _JOBS.append([])
    try:
        yield
    finally:
        delete_paths(spark, *_JOBS.pop())


def delete_paths(spark: SparkSession, *paths: str) -> None:
    """Delete folders that no later step reads."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(hadoop).delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done.

    It does so once their plans are collected as garbage, which a driver with free memory puts
    off for up to half an hour; until then they fill the disks. For use between large writes.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``staged``, with the folder, for a table that a loop deletes once it has the next."""
    path = scratch_path(df.sparkSession, name)
    if _JOBS:
        _JOBS[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str = "stage", by: Sequence[str] = ()) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    A table that several later steps read is computed once, the readers prune its
    columns, and a lost executor costs a re-read instead of the whole lineage.
    """
    path = scratch_path(df.sparkSession, name)
    if _JOBS:
        _JOBS[-1].append(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
