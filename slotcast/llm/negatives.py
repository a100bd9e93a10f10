"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

For an anchor and each of its positives the best rows of other labels are wanted whose
score lies in a window below the positive's score. A score is the inner product of integer
vectors, so it is a sum of one part per dimension, and each part grows along that
dimension's sorted list: upwards where the anchor's component is positive, downwards where
it is negative.

Index. Rows are dealt by hash to blocks of about ``BLOCK`` rows. A block is one row of a
table: its vectors, and for every dimension the order of its rows by that component.

Search. In a block, every list is read from the end that the anchor's sign names, a step
deeper each time (sorted access). Rows met for the first time are scored whole, in integers
(random access). The threshold is the score of a row made of the components last read, so
no unseen row can beat it. An anchor is done with a block as soon as the threshold is
strictly below what each of its windows still takes: its kth score so far, or its lower
end. The kth scores go from block to block inside a task. Blocks are searched in slices,
each three times as many as all before, and the kth scores of one slice start the next; so
the rows that leave the tasks stay few, and the last slice stops earliest.

Anchors are sent to the tasks in passes of about ``ANCHORS``, which bounds what is broadcast
and what the driver holds: per pass the anchors, and one score per window.

Defined cases: rows with a null label, a null vector, or a null or non-finite component
take no part. Vectors are scored with vectors of their own length only; empty ones score 0.
A null id is no anchor and comes after all ids in ties. Repeated rows are rows of their
own, also as each other's positives. A product that leaves a long integer raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotcast.llm.common import discard, staged, stored
from slotcast.session import scratch_path

BLOCK = 4096
ANCHORS = 4096
#: Blocks of the first slice.
FIRST = 4
#: Anchors whose score matrix a task holds at once.
GROUP = 256
SCALE = 256
#: Beyond every score.
FAR = 1 << 62

INDEX = (
    "slice int, size int, ids array<long>, rows array<long>, labels array<int>, "
    "vectors binary, lists binary"
)


class Anchors(NamedTuple):
    """Anchors of one length: their numbers in the pass, rows, labels and vectors."""

    number: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


class Windows(NamedTuple):
    """Score windows (anchors, slots): both ends belong to them; ``known`` is the kth score so far.

    An absent window has its low end above its high end.
    """

    low: np.ndarray
    high: np.ndarray
    known: np.ndarray


class Found(NamedTuple):
    """Entries of windows: window number, score, whether the id is null, id and row."""

    window: np.ndarray
    score: np.ndarray
    null: np.ndarray
    vec_id: np.ndarray
    row: np.ndarray


def nothing() -> Found:
    return Found(*(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64)))


def best(parts: list[Found], k: int) -> Found:
    """The first k entries of each window, windows in ascending order."""
    whole = Found(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    order = np.lexsort((whole.row, whole.vec_id, whole.null, -whole.score, whole.window))
    whole = Found(*(x[order] for x in whole))
    starts = np.flatnonzero(np.diff(whole.window, prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return Found(*(x[rank < k] for x in whole))


def kth(found: Found, k: int, known: np.ndarray) -> np.ndarray:
    """``known`` raised to the kth score of every window that has k entries."""
    known = known.copy()
    last = np.flatnonzero(np.diff(found.window, append=-1))
    full = last[np.diff(last, prepend=-1) == k]
    flat = known.reshape(-1)
    at = found.window[full]
    flat[at] = np.maximum(flat[at], found.score[full])
    return known


def exact(vectors: np.ndarray, largest: int) -> np.ndarray:
    """As doubles where every sum of products is a whole double, else as integers."""
    return vectors.astype(np.float64) if vectors.shape[1] * largest**2 < 1 << 53 else vectors


class Block:
    """One block of the index, its lists and its threshold."""

    def __init__(self, ids: list, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lists: np.ndarray):
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.rows, self.labels, self.vectors, self.lists = rows, labels, vectors, lists
        self.n, self.size = vectors.shape
        self.ends = np.take_along_axis(vectors.T, lists, axis=1) if self.size else vectors.T

    def depths(self) -> Iterator[tuple[int, int]]:
        at, to = 0, min(16, self.n)
        while at < self.n:
            yield at, to
            at, to = to, min(4 * to, self.n)

    def read(self, up: np.ndarray, down: np.ndarray, at: int, to: int) -> np.ndarray:
        """(anchors, rows): the rows that sorted access meets at these depths of the lists.

        ``up`` and ``down`` tell which lists an anchor reads from the high and the low end.
        """
        if not self.size:
            return np.ones((len(up), self.n), bool)
        met = np.zeros((2, self.size, self.n), np.float32)
        dims = np.arange(self.size)[:, None]
        met[0][dims, self.lists[:, self.n - to : self.n - at]] = 1
        met[1][dims, self.lists[:, at:to]] = 1
        return (up.astype(np.float32) @ met[0] + down.astype(np.float32) @ met[1]) > 0

    def threshold(self, anchors: np.ndarray, to: int) -> np.ndarray:
        """No row unseen at this depth scores more."""
        if not self.size:
            return np.zeros(len(anchors), anchors.dtype)
        high, low = self.ends[:, self.n - to], self.ends[:, to - 1]
        return np.maximum(anchors, 0) @ high + np.minimum(anchors, 0) @ low


def search_block(block: Block, anchors: Anchors, windows: Windows, same: bool, k: int) -> tuple[Found, int]:
    """What the block adds to the windows of a few anchors, and how many rows were scored."""
    slots = windows.low.shape[1]
    largest = int(max(np.abs(block.vectors).max(initial=0), np.abs(anchors.vectors).max(initial=0)))
    if block.size * largest**2 >= 1 << 63:
        raise OverflowError("a score would leave a long integer")
    points, rows = exact(anchors.vectors, largest), exact(block.vectors, largest)
    up, down = points > 0, points < 0
    if block.size:
        up[~(up | down).any(axis=1), 0] = True  # a zero vector scores 0 with all; one list shows them
    low, high = windows.low[anchors.number], windows.high[anchors.number]
    known = windows.known[anchors.number]
    seen = np.zeros((len(points), block.n), bool)
    live = np.flatnonzero((low <= high).any(axis=1))
    found, scored = nothing(), 0
    for at, to in block.depths():
        if not len(live):
            break
        new = block.read(up[live], down[live], at, to) & ~seen[live]
        seen[live] |= new
        some = np.flatnonzero(new.any(axis=0))
        scores = (points[live] @ rows[some].T).astype(np.int64)
        scored += len(live) * len(some)
        fits = new[:, some] & ((block.labels[some] == anchors.labels[live, None]) == same)
        fits &= block.rows[some] != anchors.rows[live, None]
        parts = [found]
        for slot in range(slots):
            least = np.maximum(low[live, slot], known[live, slot])[:, None]
            a, b = np.nonzero(fits & (scores >= least) & (scores <= high[live, slot][:, None]))
            row = some[b]
            parts.append(
                Found(live[a] * slots + slot, scores[a, b], block.null[row], block.ids[row], block.rows[row])
            )
        found = best(parts, k)
        known = kth(found, k, known)
        taken = np.where(low[live] <= high[live], np.maximum(low[live], known[live]), FAR).min(axis=1)
        live = live[block.threshold(points[live], to) >= taken]
    number = anchors.number[found.window // slots] * slots + found.window % slots
    return found._replace(window=number.astype(np.int64)), scored


def usable_rows(vectors: DataFrame, scale: int, label: Column) -> DataFrame:
    """(row, vec_id, label, size, vector) of the rows that take part; ``row`` tells them apart."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(scale * flat)
            if np.abs(whole).max(initial=0) >= 1 << 31:
                raise OverflowError(f"a component leaves 32 bits after scaling by {scale}")
            raw = whole.astype(np.int32).tobytes()
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) * 4
            cut = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if len(ends) else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(c) // 4 for c in cut], pa.int32()),
                    pa.array(cut, pa.binary()),
                ],
                ["vec_id", "label", "size", "vector"],
            )

    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    taking = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    made = taking.select(
        F.col("vec_id").cast("long"), label.cast("int").alias("label"), "embedding"
    ).mapInArrow(build, "vec_id long, label int, size int, vector binary")
    return made.select(F.monotonically_increasing_id().alias("row"), "*")


def _index_block(table: pa.Table) -> pa.Table:
    ids, rows = table["vec_id"].to_pylist(), table["row"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, rows[i]))
    table = table.take(pa.array(order))
    size = table["size"][0].as_py()
    raw = b"".join(table["vector"].to_pylist())
    vectors = np.frombuffer(raw, np.int32).reshape(len(order), size)
    lists = np.argsort(vectors.T, axis=1, kind="stable").astype(np.int32)

    def one(name: str, kind: pa.DataType) -> pa.Array:
        return pa.array([table[name].to_pylist()], pa.list_(kind))

    return pa.table(
        {
            "slice": pa.array([table["slice"][0].as_py()], pa.int32()),
            "size": pa.array([size], pa.int32()),
            "ids": one("vec_id", pa.int64()),
            "rows": one("row", pa.int64()),
            "labels": one("label", pa.int32()),
            "vectors": pa.array([raw], pa.binary()),
            "lists": pa.array([lists.tobytes()], pa.binary()),
        }
    )


def block_index(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, str, list[int]]:
    """The stored index with its folder, and its slices in the order of the search."""
    # dealt a little below the size, since hashing does not deal evenly
    parts = F.ceil(F.count("*") / (block * 0.9)).cast("int")
    counts = staged(rows.groupBy("size").agg(parts.alias("parts")), "negative-sizes")
    dealt = rows.join(counts, "size").withColumn(
        "part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    )
    step = F.floor(F.log(4.0, F.col("part") / FIRST)).cast("int") + 1
    dealt = dealt.withColumn("slice", F.when(F.col("part") < FIRST, 0).otherwise(step))
    tasks = min(10_000, counts.agg(F.sum("parts")).first()[0] or 1)
    blocks = (
        dealt.repartition(tasks, "size", "part").groupBy("size", "part").applyInArrow(_index_block, INDEX)
    )
    index, path = stored(blocks, "negative-index", ["slice"])
    slices = sorted(r.slice for r in index.select("slice").distinct().collect())
    return index, path, slices


def _look(anchors: dict[int, Anchors], windows: Windows, same: bool, k: int):
    """The worker: blocks in, the best entries of this task's blocks out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, state = nothing(), windows
        for batch in batches:
            for size, ids, rows, labels, vectors, lists in zip(
                *(batch.column(i).to_pylist() for i in range(6)), strict=True
            ):
                mine = anchors.get(size)
                if mine is None:
                    continue
                block = Block(
                    ids,
                    np.array(rows, np.int64),
                    np.array(labels, np.int32),
                    np.frombuffer(vectors, np.int32).reshape(len(ids), size).astype(np.int64),
                    np.frombuffer(lists, np.int32).reshape(size, len(ids)),
                )
                for at in range(0, len(mine.number), GROUP):
                    part = Anchors(*(x[at : at + GROUP] for x in mine))
                    found = best([found, search_block(block, part, state, same, k)[0]], k)
                state = state._replace(known=kth(found, k, state.known))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found.window),
                pa.array(found.score),
                pa.array(found.vec_id, mask=found.null),
                pa.array(found.row),
            ],
            ["window", "score", "vec_id", "row"],
        )

    return work


def search(
    index: DataFrame, slices: list[int], anchors: dict[int, Anchors], windows: Windows, same: bool, k: int
) -> tuple[DataFrame, str | None]:
    """(window, score, vec_id, row, rank): the first k entries of every window, with their folder."""
    spark = index.sparkSession
    ranked = F.row_number().over(
        W.partitionBy("window").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    )
    found, path = None, None
    for i in slices:
        blocks = index.where(F.col("slice") == i).select("size", "ids", "rows", "labels", "vectors", "lists")
        shared = spark.sparkContext.broadcast((anchors, windows))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from _look(*shared.value, same, k)(batches)

        new = blocks.mapInArrow(work, "window long, score long, vec_id long, row long")
        both = new if found is None else found.drop("rank").union(new)
        found, made = stored(both.withColumn("rank", ranked).where(F.col("rank") <= k), "negatives-found")
        if path:
            discard(spark, path)
        path = made
        if i != slices[-1]:
            known = windows.known.copy()
            for row in found.where(F.col("rank") == k).select("window", "score").collect():
                known.reshape(-1)[row.window] = row.score
            windows = windows._replace(known=known)
    return found, path


def _anchors(rows: list) -> dict[int, Anchors]:
    """Anchors by length, numbered in the order of ``rows``."""
    out = {}
    for size in {r.size for r in rows}:
        of = [(i, r) for i, r in enumerate(rows) if r.size == size]
        raw = b"".join(bytes(r.vector) for _, r in of)
        out[size] = Anchors(
            np.array([i for i, _ in of], np.int64),
            np.array([r.row for _, r in of], np.int64),
            np.array([r.label for _, r in of], np.int32),
            np.frombuffer(raw, np.int32).reshape(len(of), size).astype(np.int64),
        )
    return out


def mine_negatives(
    vectors: DataFrame,
    anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    scale: int = SCALE,
    block: int = BLOCK,
    anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has (vec_id, label, embedding). ``anchor`` says which rows are anchors and
    ``label`` what counts as their label, both over these columns. A negative's score is at
    least ``least`` hundredths of the positive's, and not above it.
    """
    spark = vectors.sparkSession
    rows = staged(usable_rows(vectors.select("vec_id", "label", "embedding"), scale, label), "negative-rows")
    index, index_path, slices = block_index(rows, block)
    asking = staged(rows.where(F.coalesce(anchor, F.lit(False))), "negative-anchors")
    passes = -(-asking.count() * 5 // (anchors * 4))  # a little fewer than the limit in each
    out = scratch_path(spark, "hard-negatives")
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    spark.createDataFrame([], schema).write.parquet(out)
    for i in range(passes):
        mine = asking.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == i).orderBy("row").collect()
        by_size = _anchors(mine)
        n = len(mine)
        whole = Windows(
            np.full((n, 1), -FAR), np.full((n, 1), FAR), np.full((n, 1), -FAR)
        )
        nearest, nearest_path = search(index, slices, by_size, whole, True, positives)
        if nearest_path is None:
            continue
        shape = (n, positives)
        windows = Windows(np.full(shape, FAR), np.full(shape, -FAR), np.full(shape, -FAR))
        for r in nearest.collect():
            windows.high[r.window, r.rank - 1] = r.score
            windows.low[r.window, r.rank - 1] = -(-least * r.score // 100)
        found, found_path = search(index, slices, by_size, windows, False, negatives)
        names = spark.createDataFrame(
            [(j, r.vec_id) for j, r in enumerate(mine)], "anchor long, anchor_id long"
        )
        paired = (
            nearest.select(
                F.col("window").alias("anchor"),
                (F.col("window") * positives + F.col("rank") - 1).alias("window"),
                F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
            )
            .join(names, "anchor")
            .join(
                found.select(
                    "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
                ),
                "window",
            )
        )
        paired.select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ).write.mode("append").parquet(out)
        discard(spark, nearest_path, found_path)
    discard(spark, index_path)
    return spark.read.schema(schema).parquet(out)
