from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotcast.llm import centroids, negatives, queries

VECTORS = "vec_id long, embedding array<float>, label int"

# --- centroid clustering -----------------------------------------------------------------


def naive_clusters(rows, clusters, rounds, length, scale=1024):
    kept = [
        (i, [int(np.floor(scale * float(np.float32(x)))) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == length and all(x is not None and np.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))
    c = [v for _, v in kept[:clusters]]

    def square(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(v):
        return min(range(len(c)), key=lambda j: (square(v, c[j]), j))

    for _ in range(rounds):
        of = [nearest(v) for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, of) if a == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, nearest(v), v) for i, v in kept]
    dist = [square(v, c[j]) for _, j, v in out]
    return sorted(
        (
            (i, j, d, sum(e for (_, a, _), e in zip(out, dist) if a == j), sum(dist),
             hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
            for (i, j, _), d in zip(out, dist)
        ),
        key=str,
    )


points = st.lists(st.floats(-50, 50), min_size=3, max_size=3).map(np.array)


@settings(max_examples=500, deadline=None)
@given(points, points, points, st.floats(0, 30), points)
def test_no_point_of_the_sphere_gets_nearer_than_the_bound(centre, old, new, radius, direction):
    bound = centroids.loosening(centre, radius, old, new)
    size = np.linalg.norm(direction)
    for share in (0, 0.5, 1):
        p = centre + (direction / size * radius * share if size else 0)
        assert np.linalg.norm(p - old) - np.linalg.norm(p - new) <= bound
    assert bound <= np.linalg.norm(new - old) * (1 + 1e-8) + 1e-5


def test_a_sphere_beside_the_way_loosens_less_and_one_behind_not_at_all():
    old, new = np.array([0.0, 0.0]), np.array([2.0, 0.0])
    assert centroids.loosening(np.array([50.0, 0.0]), 1.0, old, new) == pytest.approx(2, abs=1e-4)
    assert centroids.loosening(np.array([1.0, 50.0]), 5.0, old, new) == pytest.approx(0.2, abs=1e-4)
    assert centroids.loosening(np.array([-50.0, 0.0]), 1.0, old, new) < 1e-5
    assert centroids.loosening(np.array([1.5, 0.0]), 1.0, old, new) == pytest.approx(2, abs=1e-4)


@pytest.mark.parametrize("largest", [100, 1 << 20, (1 << 27) - 1])
def test_squared_distances_are_exact(largest):
    random = np.random.default_rng(largest)
    x = random.integers(-largest, largest, (40, 64), endpoint=True)
    c = random.integers(-largest, largest, (3, 64), endpoint=True)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, q)) for q in c] for r in x]
    assert centroids.squared_distances(x, c).tolist() == exact


def blobs(n, length, groups, seed, spread=0.05):
    random = np.random.default_rng(seed)
    middle = random.normal(size=(groups, length))
    return [
        (i, [float(x) for x in middle[i % groups] + random.normal(size=length) * spread], 0)
        for i in range(n)
    ]


def clustered(df, **more):
    return sorted((tuple(r) for r in centroids.cluster_vectors(df, **more).collect()), key=str)


def test_rounds_equal_plain_ones_and_bounds_save_scans(spark):
    rows = blobs(240, 4, 6, 1)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    report = []
    have = clustered(df, clusters=5, rounds=6, length=4, report=report)
    assert have == naive_clusters(rows, 5, 6, 4)
    assert report[0] == 240 and len(report) == 7 and min(report[1:]) < 120


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_groups_with_ties(spark, seed):
    random = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in random.integers(-3, 4, 3) / 1024], 0) for i in range(150)]
    assert clustered(spark.createDataFrame(rows, VECTORS), clusters=6, rounds=5, length=3) == naive_clusters(
        rows, 6, 5, 3
    )


def test_odd_vectors_and_columns(spark):
    rows = blobs(30, 3, 2, 4) + [
        (100, None, 0), (101, [], 0), (102, [1.0, 2.0], 0), (103, [1.0, None, 2.0], 0),
        (104, [float("nan"), 0.0, 0.0], 0), (105, [float("inf"), 0.0, 0.0], 0), (106, [0.0, 0.0, 0.0], None),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    want = naive_clusters(rows, 4, 3, 3)
    assert clustered(df, clusters=4, rounds=3, length=3) == want
    odd = df.selectExpr("*", "1 as cluster", "2 as vector", "'x' as sums", "3 as distance")
    assert clustered(odd, clusters=4, rounds=3, length=3) == want
    assert clustered(df.limit(0), length=3) == []
    few = spark.createDataFrame(rows[:3], VECTORS)
    assert clustered(few, clusters=8, rounds=2, length=3) == naive_clusters(rows[:3], 8, 2, 3)
    repeated = [rows[0]] * 4 + [(None, rows[1][1], 0)]
    twice = spark.createDataFrame(repeated, VECTORS)
    assert clustered(twice, clusters=3, rounds=2, length=3) == naive_clusters(repeated, 3, 2, 3)
    with pytest.raises(Exception, match="after scaling"):
        clustered(spark.createDataFrame([(1, [3e30, 0.0, 0.0], 0)], VECTORS), length=3)


# --- hard negatives ----------------------------------------------------------------------


def naive_negatives(rows, every=3, k=5):
    kept = [
        (i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v], n)
        for n, (i, v, label) in enumerate(rows)
        if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []

    def first(items):
        return sorted(items, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))[:k]

    for i, label, v, n in kept:
        if i is None or i % every:
            continue
        scores = [
            (sum(a * b for a, b in zip(v, w)), j, m, other)
            for j, other, w, m in kept
            if m != n and len(w) == len(v)
        ]
        for p, pid, _, _ in first([s for s in scores if s[3] == label]):
            window = [s for s in scores if s[3] != label and 80 * p <= 100 * s[0] <= 100 * p]
            out += [(i, pid, r + 1, s[1], p, s[0]) for r, s in enumerate(first(window))]
    return sorted(out, key=str)


def mined(df, every=3, **more):
    made = negatives.mine_negatives(df, anchor=F.col("vec_id") % every == 0, label=F.col("label"), **more)
    return sorted((tuple(r) for r in made.collect()), key=str)


def labelled(n, length, seed, tied=False):
    random = np.random.default_rng(seed)
    whole = random.integers(-2, 3, (n, length)) if tied else random.normal(size=(n, length))
    return [(i, [float(x) for x in v], int(random.integers(0, 4))) for i, v in enumerate(whole)]


@pytest.mark.parametrize(("length", "tied", "block"), [(5, False, 16), (3, True, 16), (2, False, 4096)])
def test_every_window_equals_brute_force(spark, length, tied, block, monkeypatch):
    monkeypatch.setattr(negatives, "FIRST", 2)
    rows = labelled(160, length, length, tied)
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df, block=block, anchors=40) == naive_negatives(rows)


def test_lists_are_left_early():
    random = np.random.default_rng(9)
    vectors = (random.normal(size=(4096, 2)) * 256).astype(np.int64)
    rows = np.arange(4096)
    block = negatives.Block(
        rows.tolist(), rows, np.zeros(4096, np.int32), vectors, np.argsort(vectors.T, axis=1).astype(np.int32)
    )
    asking = negatives.Anchors(np.arange(20), rows[:20], np.zeros(20, np.int32), vectors[:20])
    far = np.full((20, 1), negatives.FAR)
    found, scored = negatives.search_block(block, asking, negatives.Windows(-far, far, -far), True, 5)
    assert len(found.window) == 100 and scored < 20 * 4096 / 4
    for j in range(20):
        exact = sorted((-int(vectors[j] @ v), i) for i, v in enumerate(vectors) if i != j)[:5]
        at = found.window == j
        assert sorted(zip((-found.score[at]).tolist(), found.vec_id[at].tolist())) == exact


def test_odd_rows_of_negatives(spark):
    rows = labelled(60, 3, 8, tied=True) + [
        (300, None, 1), (303, [1.0, 2.0, 3.0], None), (306, [1.0, None, 2.0], 1), (309, [float("nan")] * 3, 1),
        (312, [], 1), (315, [], 1), (318, [], 2), (None, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 2),
        (321, [0.0, 0.0, 0.0], 1), (3, [1.0, 1.0, 1.0], 1), (3, [1.0, 1.0, 1.0], 1), (324, [1.0, 2.0], 1),
        (327, [2.0, 2.0], 1), (330, [2.0, 1.5], 3),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    have = mined(df)
    assert have == naive_negatives(rows)
    odd = df.selectExpr("*", "1 as size", "2 as row", "3 as score", "4 as window", "5 as slice", "6 as part")
    assert mined(odd.repartition(3)) == have
    assert mined(df.limit(0)) == []
    assert mined(df, every=1000) == naive_negatives(rows, every=1000)


def test_large_components_stay_exact(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.integers(-(2**22), 2**22, 3)], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df) == naive_negatives(rows)


@pytest.mark.parametrize("name", ["op12_centroids", "op13_hard_negatives"])
def test_queries(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def test_groups_helper():
    found = negatives.Found(*(np.array(x) for x in ([1, 0, 1, 1], [5, 2, 5, 9], [False] * 4, [7, 1, 3, 4], [0, 1, 2, 3])))
    top = negatives.best([found], 2)
    assert [[i for _, i in g] for _, g in groupby(zip(top.window.tolist(), top.vec_id.tolist()), lambda x: x[0])] == [[1], [4, 3]]
