"""Centroid clustering of integer vectors with geometric drift tightening.

Lloyd's rounds with exact integer results. Every vector carries an upper bound of the
distance to its centroid and a lower bound of the distance to any other. When centroids
move, the upper bound grows by the way of its own centroid. The lower bound would have to
shrink by the longest way any other centroid went; planar geometry shrinks it less. All
vectors of a cluster lie in a sphere about its old centroid, whose radius is the largest
upper bound. For a centroid that moves from c to c', with m half-way between, a point p
gets nearer by

    |p - c| - |p - c'|  =  (|p - c|^2 - |p - c'|^2) / (|p - c| + |p - c'|)
                       <=  |c' - c| * cos(angle at m between p and c'),

since the sum of the two distances is at least twice that from m. In the plane through the
sphere's centre, c and c', the sphere is seen from m within asin(radius / distance) of its
centre, which gives the least angle. Only where m lies in the sphere is it the whole way,
and a sphere that lies behind m loosens nothing. A vector whose upper bound stays below its
lower bound keeps its cluster unseen; the others are ambiguous and scanned exactly, in
integers, ties to the smaller number. Bounds are widened a little for rounding, so they
only ever decide what integers would decide alike.

A round reads the vectors with their bounds and writes them with the new ones, without a
shuffle; each batch adds one row of sums and radii, which Spark adds up to one row per
component. The vectors of the round before are deleted once the next are written. Centroids
are as many numbers as ``clusters`` times the length.

Defined cases: vectors of another length, null ones, and ones with null or non-finite
components take no part and give no row. Null ids take part and come last in the starting
order; equal ids start in the order of their components. Repeated rows count as often as
they occur; two equal starting vectors leave the later centroid empty, and it stays where it
is. With fewer vectors than ``clusters`` there are as many clusters as vectors. A scaled
component of 2^27 or more raises an error, since its squares would leave a long integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import discard, staged, stored

CLUSTERS = 8
ROUNDS = 10
LENGTH = 64
SCALE = 1024
LARGEST = 1 << 27
#: Bounds are widened by this share and this much, far beyond any rounding of theirs.
SHARE, MUCH = 1e-9, 1e-6

STATE = "vec_id long, vector binary, cluster int, upper double, lower double, sums array<long>, radii array<double>, scanned long"


class Move(NamedTuple):
    """Centroids, and how much each cluster's bounds change on the way to them."""

    centroids: np.ndarray
    drift: np.ndarray
    loosening: np.ndarray


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, rows of c) of integers."""
    largest = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4 * x.shape[1] * int(largest) ** 2 < 1 << 53:  # every step is a whole double
        a, b = x.astype(np.float64), c.astype(np.float64)
        whole = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return whole.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """How much nearer ``old`` gets, at most, to any point of the sphere by moving to ``new``."""
    way = (new - old).astype(np.float64)
    drift = float(np.sqrt((way * way).sum()))
    if not drift:
        return 0.0
    whole = drift * (1 + SHARE) + MUCH
    seen = centre - (old + new) / 2.0
    distance = float(np.sqrt((seen * seen).sum()))
    if distance <= radius * (1 + SHARE) + MUCH:
        return whole
    between = np.arccos(np.clip(float(seen @ way) / (distance * drift), -1.0, 1.0))
    angle = between - np.arcsin(min(1.0, radius * (1 + SHARE) / distance)) - SHARE
    if angle <= 0:
        return whole
    return min(whole, max(0.0, drift * float(np.cos(min(angle, np.pi / 2)))) * (1 + SHARE) + MUCH)


def moved(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> Move:
    """What the move of the centroids does to the bounds of each cluster."""
    k = len(old)
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1)) * (1 + SHARE) + MUCH
    nearer = [
        max((loosening(old[i], radii[i], old[j], new[j]) for j in range(k) if j != i), default=0.0)
        for i in range(k)
    ]
    return Move(new, drift, np.array(nearer))


def assign(
    x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster and bounds of each vector after the move, and how many were scanned.

    Vectors without a cluster (-1) are scanned.
    """
    known = cluster >= 0
    upper = np.where(known, upper + move.drift[cluster], np.inf)
    lower = np.where(known, lower - move.loosening[cluster], -np.inf)
    cluster = cluster.copy()
    open_ = np.flatnonzero(~(upper < lower))
    own = open_[known[open_]]
    if len(own):
        # the exact distance to the own centroid settles some without a look at the others
        for i in np.unique(cluster[own]):
            rows = own[cluster[own] == i]
            exact = squared_distances(x[rows], move.centroids[i : i + 1])[:, 0]
            upper[rows] = np.sqrt(exact.astype(np.float64)) * (1 + SHARE) + MUCH
        open_ = open_[~(upper[open_] < lower[open_])]
    if len(open_):
        distances = squared_distances(x[open_], move.centroids)
        best = distances.argmin(axis=1)  # the first of equal ones
        at = np.arange(len(open_))
        cluster[open_] = best
        upper[open_] = np.sqrt(distances[at, best].astype(np.float64)) * (1 + SHARE) + MUCH
        if len(move.centroids) > 1:
            distances[at, best] = np.iinfo(np.int64).max
            second = np.sqrt(distances.min(axis=1).astype(np.float64))
            lower[open_] = second * (1 - SHARE) - MUCH
        else:
            lower[open_] = np.inf
    return cluster, upper, lower, len(open_)


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.int32).reshape(-1, length).astype(np.int64)


def integer_vectors(vectors: DataFrame, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the vectors that take part, as 32-bit integers."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(scale * flat.reshape(-1, length))
            if np.abs(whole).max(initial=0) >= LARGEST:
                raise OverflowError(f"a component is {LARGEST} or more after scaling by {scale}")
            rows = [row.tobytes() for row in whole.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.binary())], ["vec_id", "vector"]
            )

    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    fitting = vectors.where((F.size("embedding") == length) & finite)
    return fitting.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        build, "vec_id long, vector binary"
    )


def starting_centroids(kept: DataFrame, clusters: int, length: int, seed: int) -> np.ndarray:
    marked = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(marked.asc_nulls_last(), "vector").limit(clusters).collect()
    raw = b"".join(bytes(r.vector) for r in rows)
    return np.frombuffer(raw, np.int32).reshape(-1, length).astype(np.int64)


def _assigned(state: DataFrame, move: Move, length: int) -> DataFrame:
    """The state after the move; every batch adds one row with its sums and radii."""
    shared = state.sparkSession.sparkContext.broadcast(move)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        move = shared.value
        k = len(move.centroids)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column(1), length)
            before = (c.to_numpy(zero_copy_only=False) for c in batch.columns[2:5])
            cluster, upper, lower, scanned = assign(x, *before, move)
            of = cluster[None, :] == np.arange(k)[:, None]
            sums = np.concatenate([[[o.sum(), *x[o].sum(axis=0)] for o in of]]).astype(np.int64)
            radii = [float(upper[o].max(initial=0.0)) for o in of]
            n = batch.num_rows

            def last(values: list, kind: pa.DataType) -> pa.Array:
                return pa.array([None] * n + [values], kind)

            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(1, pa.int64())]),
                    pa.concat_arrays([batch.column(1), pa.nulls(1, batch.column(1).type)]),
                    pa.array([*cluster.tolist(), None], pa.int32()),
                    pa.array([*upper.tolist(), None], pa.float64()),
                    pa.array([*lower.tolist(), None], pa.float64()),
                    last(sums.ravel().tolist(), pa.list_(pa.int64())),
                    last(radii, pa.list_(pa.float64())),
                    last(scanned, pa.int64()),
                ],
                ["vec_id", "vector", "cluster", "upper", "lower", "sums", "radii", "scanned"],
            )

    return state.select("vec_id", "vector", "cluster", "upper", "lower").mapInArrow(work, STATE)


def _summed(state: DataFrame, k: int, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts and sums (k, 1 + length) as Python integers, radii, and vectors scanned."""
    batches = state.where("sums is not null")
    parts = batches.select(F.posexplode("sums").alias("place", "part"))
    rows = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total")).collect()
    sums = np.zeros(k * (1 + length), dtype=object)
    for row in rows:
        sums[row.place] = int(row.total)
    widest = [F.max(F.col("radii")[i]).alias(f"r{i}") for i in range(k)]
    last = batches.agg(F.sum("scanned").alias("scanned"), *widest).first()
    radii = np.array([last[f"r{i}"] or 0.0 for i in range(k)])
    return sums.reshape(k, 1 + length), radii, last.scanned or 0


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    seed: int = 3,
    report: list[int] | None = None,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector kept.

    ``report`` gets the number of vectors that each assignment scanned.
    """
    spark = vectors.sparkSession
    kept, path = stored(integer_vectors(vectors, length, scale), "cluster-vectors")
    centroids = starting_centroids(kept, clusters, length, seed)
    k = len(centroids)
    state = kept.selectExpr(
        "vec_id", "vector", "-1 as cluster", "cast(0 as double) as upper", "cast(0 as double) as lower"
    )
    move = Move(centroids, np.zeros(k), np.zeros(k))
    for at in range(rounds + 1 if k else 0):
        state, new = stored(_assigned(state, move, length), "clustered")
        discard(spark, path)
        path = new
        sums, radii, scanned = _summed(state, k, length)
        state = state.where("sums is null")
        if report is not None:
            report.append(scanned)
        if at < rounds:
            centroids = move.centroids.copy()
            for i, (count, *total) in enumerate(sums):
                if count:
                    centroids[i] = [t // count for t in total]
            move = moved(move.centroids, centroids, radii)
    placed = staged(_measured(state, move.centroids, length), "cluster-distances")
    discard(spark, path)
    total = F.sum(F.col("distance").cast("decimal(20,0)"))
    rows = {r.cluster: int(r.total) for r in placed.groupBy("cluster").agg(total.alias("total")).collect()}
    digests = [
        hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest()
        for row in move.centroids
    ]
    whole = sum(rows.values())
    finals = spark.createDataFrame(
        [(i, rows.get(i, 0), whole, digests[i]) for i in range(k)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return placed.join(F.broadcast(finals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _measured(state: DataFrame, centroids: np.ndarray, length: int) -> DataFrame:
    """(vec_id, cluster, distance): the exact squared distance to the own centroid."""
    shared = state.sparkSession.sparkContext.broadcast(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cluster = _vectors(batch.column(1), length), batch.column(2).to_numpy()
            distance = ((x - shared.value[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return state.select("vec_id", "vector", "cluster").mapInArrow(
        work, "vec_id long, cluster int, distance long"
    )
