from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from series_vectors import START

from slotcast.plans import matrix, ridge


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    out = []
    for name in ("a", "b"):
        for h in (4, 60, 160):
            used = matrix.bucket_of(h).features
            for i in range(60):
                row = {f: draw.gauss(10, 3) for f in used}
                row["year"] = 2024.0 if "year" in used else None  # does not vary
                row["temperature"] = row["dew_point"] * 2 if i % 2 else row["dew_point"] * 2 + 1e-9
                target = 5 * row["block_load"] - row["dow"] + draw.gauss(0, 1)
                out.append((name, START + timedelta(minutes=15 * i), h, *[row.get(f) for f in matrix.FEATURES], target))
    out.append(("a", START, 4, *[None] * len(matrix.FEATURES), None))
    columns = ", ".join(f"{f} double" for f in matrix.FEATURES)
    return spark.createDataFrame(
        out, f"series_id string, datetime timestamp_ntz, horizon int, {columns}, target double"
    )


def naive(group, strength):
    x = np.array([[np.nan if r[f] is None else r[f] for f in matrix.FEATURES] for r in group])
    y = np.array([r.target for r in group])
    keep = [i for i in range(x.shape[1]) if not np.isnan(x[:, i]).any() and x[:, i].std() > 1e-6]
    z = (x[:, keep] - x[:, keep].mean(0)) / x[:, keep].std(0)
    a = z.T @ z / len(y) + strength * np.eye(len(keep))
    w = np.linalg.solve(a, z.T @ (y - y.mean()) / len(y))
    return {matrix.FEATURES[i]: v for i, v in zip(keep, w)}, y.mean() + z @ w


@pytest.mark.parametrize("strength", [0.1, 1e-3])
def test_weights_and_forecasts_equal_the_dense_solution(rows, strength):
    fits = ridge.fit(rows.repartition(7), strength=strength).cache()
    have = {}
    for r in ridge.weights(fits).collect():
        have.setdefault((r.series_id, r.horizon), {})[r.feature] = r.weight
    groups = {}
    for r in ridge.forecast(rows, fits).where("target is not null").orderBy("datetime").collect():
        groups.setdefault((r.series_id, r.horizon), []).append(r)
    assert set(have) == set(groups) == {(s, h) for s in "ab" for h in (4, 60, 160)}
    for key, group in groups.items():
        w, predicted = naive(group, strength)
        assert have[key] == pytest.approx(w, rel=1e-7, abs=1e-7)
        assert [r.forecast for r in group] == pytest.approx(list(predicted), rel=1e-8)
        assert "year" not in have[key]


def test_one_row_no_rows_and_wrong_strength(rows):
    one = ridge.fit(rows.where("series_id = 'a' and horizon = 4 and target is not null").limit(1))
    assert ridge.weights(one).count() == 0 and one.count() == 1
    assert ridge.fit(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ridge.fit(rows, strength=0)


def test_fewer_features_than_all(rows):
    small = rows.where("horizon = 4").select(
        "series_id", "datetime", "horizon", *matrix.bucket_of(4).features, "target"
    )
    want = {(r.series_id, r.feature): r.weight for r in ridge.weights(ridge.fit(rows)).where("horizon = 4").collect()}
    have = {(r.series_id, r.feature): r.weight for r in ridge.weights(ridge.fit(small)).collect()}
    assert have == pytest.approx(want, rel=1e-12) and len(have) == len(want) > 20
    assert ridge.fit(small).select(F.size("weights")).first()[0] == len(matrix.FEATURES)
