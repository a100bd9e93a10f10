"""Embedding near-dedup with a pivot-permutation index.

Reference points (pivots) are drawn from the data. Each vector is described by its
``nearest`` pivots in order of similarity and stands in the inverted list of each of
them. Two vectors that share at least ``shared`` of these pivots are candidates, and a
candidate is verified by its cosine in double precision. Links that share fewer pivots
are lost; the tests measure the recall against brute force.

A list is worked through in blocks of at most ``BLOCK`` members, every pair of blocks in
one task, so a hot list is many tasks and no task holds more than two blocks. A task
returns, per member, how many vectors it links and a spanning forest of its links, never
the pairs. A pair that meets in several lists counts in the list of its least shared
pivot alone. Equal vectors are one node with a weight.

The pivots are fitted on a bounded sample: four times as many vectors as there will be
pivots, with the lowest hashes, thinned so that no two pivots are closer than ``APART``.
Their number grows with the root of the vectors, up to ``PIVOTS`` and ``PIVOT_NUMBERS``, and
the permutations grow with the logarithm of the pivots: with a fixed length, similar vectors
would share ever fewer of ever more pivots. In random directions of 64 dimensions, pairs at
cosine 0.90 share four of them with chance 0.999 at 256 pivots, 0.994 at 1,024, 0.994 at
4,096 and 0.99 at 16,384. Every vector is indexed. Beyond some 16 million vectors of a
length the pivots stop growing, and the lists' work grows with the square from there on.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing. Vectors link with vectors of their own length only, each length having
pivots of its own. Null ids take part and never name a component unless nothing else does.
Repeated rows link each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import staged
from slotcast.llm.components import connected_components

PIVOTS = 16_384
#: Numbers in the pivots of one length together; longer vectors get fewer pivots.
PIVOT_NUMBERS = 1 << 22
APART = 0.8
SHARED = 4
BLOCK = 1024
#: Lengths with no more vectors than this need no pivots: they are one list.
SINGLE = 1024


def nearest_of(pivots: int) -> int:
    """Length of a permutation. Each doubling of the pivots adds one place, since the nearest
    pivots of two similar vectors then differ more."""
    return max(10, 4 + math.ceil(math.log2(max(1, pivots))))


def matrices_of(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length (rows, unit vectors in double) of the entries of a list column that can link."""
    kept: dict[int, tuple[list, list]] = {}
    for i, value in enumerate(column.to_pylist()):
        if value and None not in value:
            vector = np.array(value, dtype=np.float64)
            size = np.linalg.norm(vector)
            if 0 < size < math.inf:
                rows, vectors = kept.setdefault(len(value), ([], []))
                rows.append(i)
                vectors.append(vector / size)
    return {n: (np.array(rows, np.int64), np.array(vectors)) for n, (rows, vectors) in kept.items()}


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, size, node, unit) of the vectors that can link; ``node`` stands for the vector."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, (kept, units) in matrices_of(batch.column(1)).items():
                raw = [u.tobytes() for u in units]
                nodes = np.array([xxhash.xxh3_64_intdigest(r) for r in raw], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(kept)),
                        pa.array(np.full(len(kept), size, np.int32)),
                        pa.array(nodes.view(np.int64)),
                        pa.array(raw, pa.binary()),
                    ],
                    ["vec_id", "size", "node", "unit"],
                )

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        build, "vec_id long, size int, node long, unit binary"
    )


def choose_pivots(nodes: DataFrame, count: int, length: int, most: int = PIVOTS) -> np.ndarray:
    """Pivots from a bounded sample, about four times the root of ``count`` of them."""
    wanted = min(most, max(1, PIVOT_NUMBERS // length), max(16, math.isqrt(16 * count)))
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(4 * wanted)
    pivots, held = 0, np.zeros((wanted, length))
    for row in drawn.select("unit").toLocalIterator():
        unit = np.frombuffer(row.unit)
        if not pivots or (held[:pivots] @ unit).max() < APART:
            held[pivots] = unit
            pivots += 1
        if pivots == wanted:
            break
    return held[:pivots]


def pivot_lists(nodes: DataFrame, pivots: dict[int, np.ndarray], nearest: int | None, shared: int) -> DataFrame:
    """(size, pivot, node, unit, order, weight, need): each node once per pivot of its permutation.

    ``need`` pivots must be shared; where there are fewer than a full permutation of ten, a
    like part of them. Vectors of a length without pivots stand in one list.
    """
    sent = nodes.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                points = sent.value.get(int(size))
                rows = np.flatnonzero(sizes == size)
                for at in range(0, len(rows), 2048):
                    part = batch.take(pa.array(rows[at : at + 2048]))
                    if points is None:
                        k, need = 1, 1
                        order = np.zeros((part.num_rows, 1), np.int64)
                    else:
                        full = nearest or nearest_of(len(points))
                        k = min(full, len(points))
                        need = shared if k >= 10 else max(1, shared * k // 10)
                        units = np.frombuffer(b"".join(part.column(2).to_pylist())).reshape(part.num_rows, -1)
                        order = np.argsort(-(units @ points.T), axis=1, kind="stable")[:, :k]
                    take = pa.array(np.repeat(np.arange(part.num_rows), k))
                    orders = pa.array(order.tolist(), pa.list_(pa.int32()))
                    n = part.num_rows * k
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, size, np.int32)),
                            pa.array(order.ravel().astype(np.int32)),
                            part.column(0).take(take),
                            part.column(2).take(take),
                            orders.take(take),
                            part.column(3).take(take),
                            pa.array(np.full(n, need, np.int32)),
                        ],
                        ["size", "pivot", "node", "unit", "order", "weight", "need"],
                    )

    return nodes.select("node", "size", "unit", "weight").mapInArrow(
        describe,
        "size int, pivot int, node long, unit binary, order array<int>, weight long, need int",
    )


def forest(links: np.ndarray) -> np.ndarray:
    """The least index of each member's component, of a symmetric link matrix."""
    root = np.arange(len(links))
    while True:
        near = np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def block_links(threshold: float):
    """The worker of one pair of blocks of a list."""

    def work(table: pa.Table) -> pa.Table:
        pivot, side = table["pivot"][0].as_py(), table["side"].to_numpy()
        node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
        units = np.frombuffer(b"".join(table["unit"].to_pylist())).reshape(len(node), -1)
        order = np.array(table["order"].to_pylist())
        names, flat = np.unique(order, return_inverse=True)
        has = np.zeros((len(node), len(names)), np.float32)
        has[np.arange(len(node))[:, None], flat.reshape(order.shape)] = 1
        candidate = has @ has.T >= table["need"][0].as_py()
        lower = has[:, names < pivot]
        candidate &= lower @ lower.T == 0  # a lower shared pivot owns the pair
        if side.any():
            candidate &= side[:, None] != side[None, :]
        np.fill_diagonal(candidate, False)
        a, b = np.nonzero(np.triu(candidate))
        ok = np.concatenate(
            [
                np.einsum("ij,ij->i", units[a[i : i + 65536]], units[b[i : i + 65536]]) >= threshold
                for i in range(0, len(a), 65536)
            ]
            or [np.zeros(0, bool)]
        )
        links = np.zeros(candidate.shape, bool)
        links[a[ok], b[ok]] = links[b[ok], a[ok]] = True
        some = links.any(axis=1)
        root = forest(links)
        return pa.table(
            {
                "node": pa.array(node[some]),
                "links": pa.array((links @ weight)[some].astype(np.int64)),
                "root": pa.array(node[root[some]]),
            }
        )

    return work


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    nearest: int | None = None,
    shared: int = SHARED,
    block: int = BLOCK,
    single: int = SINGLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding).

    ``nearest`` is the length of a permutation, by default that of ``nearest_of``.
    """
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding")
    usable = staged(usable_vectors(vectors), "vectors")
    nodes = staged(
        usable.groupBy("node").agg(
            F.first("size").alias("size"), F.first("unit").alias("unit"), F.count("*").alias("weight")
        ),
        "nodes",
    )
    counts = nodes.groupBy("size").count().where(F.col("count") > single).collect()
    pivots = {
        r["size"]: choose_pivots(nodes.where(F.col("size") == r["size"]), r["count"], r["size"]) for r in counts
    }
    lists = staged(pivot_lists(nodes, pivots, nearest, shared), "pivot-lists")
    # members are dealt to blocks by hash; a block meets itself and every later block
    key = ["size", "pivot"]
    blocks = lists.groupBy(*key).agg(F.ceil(F.count("*") / (block * 0.8)).cast("int").alias("blocks"))
    dealt = lists.join(blocks, key).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key,
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node",
        "unit",
        "order",
        "weight",
        "need",
    )
    found = staged(
        met.groupBy(*key, "lo", "hi").applyInArrow(
            block_links(threshold), "node long, links long, root long"
        ),
        "links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    marked = (
        usable.drop("unit", "size")
        .join(nodes.select("node", "weight"), "node")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("comp"),
        )
    )
    lowest = marked.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    linking = marked.join(lowest, "comp").select("vec_id", "n_links", "component_id")
    rest = others(vectors)
    return linking.union(rest).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def others(vectors: DataFrame) -> DataFrame:
    """Rows for the vectors that cannot link."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [rows for rows, _ in matrices_of(batch.column(1)).values()]
            rest = np.setdiff1d(np.arange(batch.num_rows), np.concatenate([np.zeros(0, np.int64), *kept]))
            ids = batch.column(0).take(pa.array(rest))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.zeros(len(rest), np.int64)), ids],
                ["vec_id", "n_links", "component_id"],
            )

    return vectors.mapInArrow(build, "vec_id long, n_links long, component_id long")
