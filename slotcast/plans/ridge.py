"""Ridge regression of every horizon's target on its full feature list, all models at once.

Two aggregations with map-side sums: the means of a model's features, then the products of
their deviations (the Gram matrix, with the target as its last column). What is left is one
row per model with a matrix of fixed size, and its equations are solved inside that row by
a Cholesky factorisation in higher-order functions. A model is as many sums whatever the
number of its rows, so a hot series costs no more after the map side than any other.

Features are scaled to unit deviation. One that does not vary, or that the horizon does not
use, has weight 0. ``strength`` is added to the diagonal of the correlations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.operators.blocks import KEYS

from .matrix import FEATURES

STRENGTH = 0.1
#: A feature varies if its mean square deviation exceeds this share of one plus its mean's square.
LEAST_VARIANCE = 1e-12
SIZE = len(FEATURES)


def _columns(rows: DataFrame) -> list[Column]:
    here = set(rows.columns)
    return [(F.col(c) if c in here else F.lit(None)).cast("double") for c in FEATURES]


def _row(i: int) -> int:
    """Where the products of column i with itself and later columns begin."""
    return i * (SIZE + 1) - i * (i - 1) // 2


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _reals() -> Column:
    return F.array().cast("array<double>")


def gram(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, horizon, n, means, products) of rows with a target; both arrays end with it."""
    by = [*keys, "horizon"]
    rows = rows.where("target is not null")
    values = [*_columns(rows), F.col("target")]
    means = rows.groupBy(*by).agg(F.array(*[F.avg(v) for v in values]).alias("means"))
    apart = [F.coalesce(v - F.col("means")[i], F.lit(0.0)).alias(f"d{i}") for i, v in enumerate(values)]
    shifted = rows.join(means, by).select(*by, "means", *apart)
    sums = [F.sum(F.col(f"d{i}") * F.col(f"d{j}")) for i in range(SIZE + 1) for j in range(i, SIZE + 1)]
    return shifted.groupBy(*by).agg(
        F.count("*").alias("n"), F.any_value("means").alias("means"), F.array(*sums).alias("products")
    )


def cholesky(rows: Column) -> Column:
    """The lower factor of a matrix given by its lower rows, as rows that end on the diagonal."""

    def next_row(factor: Column, row: Column) -> Column:
        last = F.size(row) - 1

        def entry(done: Column, j: Column) -> Column:
            other = F.get(factor, j)
            below = (F.get(row, j) - _dot(done, F.slice(other, 1, j))) / F.get(other, j)
            return F.when(j < last, below).otherwise(F.sqrt(F.get(row, j) - _dot(done, done)))

        built = F.aggregate(
            F.sequence(F.lit(0), last), _reals(), lambda done, j: F.concat(done, F.array(entry(done, j)))
        )
        return F.concat(factor, F.array(built))

    return F.aggregate(rows, F.array().cast("array<array<double>>"), next_row)


def solve(factor: Column, right: Column) -> Column:
    """x of factor * factor' * x = right."""
    size = F.size(factor)

    def forward(done: Column, i: Column) -> Column:
        row = F.get(factor, i)
        return F.concat(done, F.array((F.get(right, i) - _dot(done, F.slice(row, 1, i))) / F.get(row, i)))

    half = F.aggregate(F.sequence(F.lit(0), size - 1), _reals(), forward)

    def backward(done: Column, i: Column) -> Column:
        below = F.transform(F.slice(factor, i + 2, size - 1 - i), lambda row: F.get(row, i))
        return F.concat(F.array((F.get(half, i) - _dot(below, done)) / F.get(F.get(factor, i), i)), done)

    return F.aggregate(F.sequence(size - 1, F.lit(0), F.lit(-1)), _reals(), backward)


def fit(rows: DataFrame, keys: Sequence[str] = KEYS, strength: float = STRENGTH) -> DataFrame:
    """(keys, horizon, n, means, deviations, weights); weights are per unit of deviation.

    ``means`` has the target's mean last; a deviation of 0 marks a feature without weight.
    """
    if strength <= 0:
        raise ValueError("strength must be positive; features may depend on each other")
    products = F.col("products")
    deviations = F.array(
        *[
            F.when(
                products[_row(i)] / F.col("n")
                > LEAST_VARIANCE * (1 + F.coalesce(F.col("means")[i], F.lit(0.0)) ** 2),
                F.sqrt(products[_row(i)] / F.col("n")),
            ).otherwise(0.0)
            for i in range(SIZE)
        ]
    )
    scaled = gram(rows, keys).withColumn("deviations", deviations)

    def like(i: int, j: int) -> Column:
        """Correlation of two features, j <= i; with the target its share of deviation."""
        scale = F.col("n") * F.col("deviations")[i] * F.col("deviations")[j]
        here = F.when(scale > 0, products[_row(j) + i - j] / scale).otherwise(0.0)
        return here + strength if i == j else here

    matrix = F.array(*[F.array(*[like(i, j) for j in range(i + 1)]) for i in range(SIZE)])
    right = F.array(
        *[
            F.when(
                F.col("deviations")[i] > 0,
                products[_row(i) + SIZE - i] / (F.col("n") * F.col("deviations")[i]),
            ).otherwise(0.0)
            for i in range(SIZE)
        ]
    )
    factored = scaled.select("*", cholesky(matrix).alias("factor"), right.alias("right"))
    return factored.select(
        *keys, "horizon", "n", "means", "deviations", solve(F.col("factor"), F.col("right")).alias("weights")
    )


def weights(fits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, horizon, feature, weight): one row per feature that has one."""
    names = F.array(*map(F.lit, FEATURES))
    each = F.arrays_zip(names.alias("feature"), F.col("deviations"), F.col("weights").alias("weight"))
    rows = fits.select(*keys, "horizon", F.inline(each))
    return rows.toDF(*keys, "horizon", "feature", "deviation", "weight").where("deviation > 0").drop("deviation")


def forecast(rows: DataFrame, fits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``rows`` with ``forecast``, for those whose model there is."""
    joined = rows.withColumn("_values", F.array(*_columns(rows))).join(
        fits.select(*keys, "horizon", "means", "deviations", "weights"), [*keys, "horizon"]
    )
    parts = [
        F.when(
            F.col("deviations")[i] > 0,
            F.col("weights")[i] * (F.col("_values")[i] - F.col("means")[i]) / F.col("deviations")[i],
        ).otherwise(0.0)
        for i in range(SIZE)
    ]
    total = F.col("means")[SIZE]
    for part in parts:
        total = total + part
    return joined.withColumn("forecast", total).select(*rows.columns, "forecast")
