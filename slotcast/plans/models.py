"""One boosted-tree regressor per horizon."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from slotcast.operators.blocks import KEYS
from slotcast.session import staged

from .matrix import bucket_of, rows_for


class Boosting(NamedTuple):
    first: int
    last: int
    step: float
    depth: int
    rounds: int
    sampling: float = 1.0


# Learning rate, depth and rounds per horizon. The last horizon has its own.
# Where no rate or depth is given 0.1 and 6 stand in; sampling stands in for bagging.
BOOSTING = [
    Boosting(4, 7, 0.1, 8, 1000),
    Boosting(8, 19, 0.1, 7, 1200),
    Boosting(20, 39, 0.7, 5, 1000),
    Boosting(40, 55, 0.3, 10, 1000),
    Boosting(56, 71, 0.02, 8, 700),
    Boosting(72, 119, 0.015, 10, 900, 0.8),
    Boosting(120, 159, 0.1, 6, 1300),
    Boosting(160, 160, 0.1, 6, 800),
]


def boosting_of(horizon: int) -> Boosting:
    for setting in BOOSTING:
        if setting.first <= horizon <= setting.last:
            return setting
    raise ValueError(f"no setting for horizon {horizon}")


def regressor(
    horizon: int, rounds: int | None = None, depth: int | None = None, seed: int = 42
) -> Pipeline:
    """Assembler and regressor with the horizon's features and settings.

    ``rounds`` and ``depth`` stand in for the horizon's own only where a caller gives them.
    """
    setting = boosting_of(horizon)
    assembler = VectorAssembler(
        inputCols=list(bucket_of(horizon).features), outputCol="features"
    )
    trees = GBTRegressor(
        featuresCol="features",
        labelCol="target",
        predictionCol="forecast",
        lossType="squared",
        stepSize=setting.step,
        maxDepth=depth or setting.depth,
        maxIter=rounds or setting.rounds,
        subsamplingRate=setting.sampling,
        checkpointInterval=10,
        seed=seed,
    )
    return Pipeline(stages=[assembler, trees])


def model_path(root: str, horizon: int) -> str:
    return f"{root}/horizon={horizon}"


def stage_matrix(matrix: DataFrame) -> DataFrame:
    """Write the matrix by horizon, so that each fit reads only its own rows."""
    # Rebalancing splits a horizon over as many files as its size asks for.
    return staged(matrix.hint("rebalance", "horizon"), "matrix", ["horizon"])


def train_models(
    matrix: DataFrame,
    horizons: Sequence[int],
    root: str,
    rounds: int | None = None,
    depth: int | None = None,
    parallelism: int = 4,
) -> list[str]:
    """Fit and store one model per horizon; fits share the cluster ``parallelism`` at a time.

    Every horizon is a task of its own. The models are saved as they finish; failures are
    collected, and raised together when all other horizons are stored.
    """

    @inheritable_thread_target(matrix.sparkSession)
    def fit(horizon: int) -> tuple[str, Exception | None]:
        path = model_path(root, horizon)
        try:
            rows = rows_for(matrix, horizon)
            regressor(horizon, rounds, depth).fit(rows).write().overwrite().save(path)
        except Exception as error:  # noqa: BLE001
            return path, error
        return path, None

    with ThreadPool(max(1, min(parallelism, len(horizons)))) as pool:
        done = pool.map(fit, horizons, chunksize=1)
    failed = {h: error for h, (_, error) in zip(horizons, done, strict=True) if error}
    if failed:
        listed = "; ".join(f"horizon {h}: {str(error)[:200]}" for h, error in failed.items())
        raise RuntimeError(f"{len(failed)} of {len(horizons)} horizons failed: {listed}")
    return [path for path, _ in done]


def load_model(root: str, horizon: int) -> PipelineModel:
    return PipelineModel.load(model_path(root, horizon))


def predict(newest: DataFrame, horizons: Iterable[int], root: str) -> DataFrame:
    """Forecast of each horizon's rows with its stored model."""
    scored = [
        load_model(root, h)
        .transform(rows_for(newest, h))
        .select(*KEYS, "datetime", "horizon", "forecast")
        for h in horizons
    ]
    return reduce(DataFrame.unionByName, scored)
