"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is lower-cased and cut at ASCII characters that are neither letters nor digits. Its
features are its words, its pairs of neighbours, and its pairs with one and with two words
between, each kind hashed into 2^24 places of its own; a feature is there or not, however
often it occurs. The learner keeps two sums per coordinate, of gradients and of their
squares. The second gives every coordinate a rate of its own; the first leaves its weight at
exactly zero until it passes the L1 bound, so that a few hundred weights remain and go to
every task.

The learner is sequential, so it takes a bounded sample: the ``SAMPLE`` labelled rows of the
lowest hashes, as long as they hold no more than ``MOST`` features. Features that fewer than
``LEAST`` sampled rows hold are left out of the model. Features are made in parallel; one
task walks ``EPOCHS`` times over the sample in hash order, so reruns and other partitionings
give the same weights. Scoring runs over every whole text without a shuffle.

Defined cases: a null or empty text has no features and scores by the intercept; without
labelled rows every score is 0.5. A document id that is labelled more than once is toxic if
any of its labels is 1; null labels and null ids teach nothing. Equal rows of one id teach
once; different texts of one id teach each. A null id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotcast.llm.common import staged
from slotcast.llm.tokens import Remembered

#: Largest number of labelled rows, and of features they hold together, that a fit takes.
SAMPLE = 16_384
MOST = 1 << 26
#: Sampled rows that hold a feature of the model, at least.
LEAST = 3
EPOCHS = 4
#: Distances between the two words of a pair: neighbours, one word between, two words between.
GAPS = (1, 2, 3)
PLACES = 24
U64 = np.uint64

_LETTERS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


class Rates(NamedTuple):
    """Parameters of the learner: step, its damping, and the L1 and L2 bounds."""

    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0


class Weights(NamedTuple):
    """Places of the non-zero weights in ascending order, the weights, and the intercept."""

    places: np.ndarray
    values: np.ndarray
    intercept: float


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def features_of(text: str | None) -> np.ndarray:
    """Distinct places of a text's words and pairs, ascending."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_LETTERS).split()
    ids = np.fromiter(map(_word_hashes().__getitem__, words), dtype=U64, count=len(words))
    kinds = [ids] + [_mixed(ids[:-g] * U64(3) + _mixed(ids[g:])) for g in GAPS if g < len(ids)]
    places = [
        (_mixed(kind + U64(k)) >> U64(64 - PLACES)) | (U64(k) << U64(PLACES))
        for k, kind in enumerate(kinds)
    ]
    return np.unique(np.concatenate(places).astype(np.uint32))


def present(places: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where in the ascending ``among`` those of ``places`` stand that it holds."""
    if not len(among):
        return np.zeros(0, np.int64)
    at = np.searchsorted(among, places)
    at[at == len(among)] = 0
    return at[among[at] == places]


def chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-min(max(margin, -35.0), 35.0))))


def ftrl(rows: list[np.ndarray], labels: list[int], size: int, epochs: int, rates: Rates) -> np.ndarray:
    """Weights of ``size`` coordinates and, last, the intercept, which no L1 bound holds.

    ``rows`` are the coordinates present in each row, walked in their order.
    """
    alpha, beta, l1, l2 = rates
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    bound = np.full(size + 1, l1)
    bound[size] = 0.0

    def weights(at: np.ndarray | slice) -> np.ndarray:
        over = np.abs(z[at]) - bound[at]
        return np.where(over > 0, -np.sign(z[at]) * over / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    rows = [np.append(row, size) for row in rows]
    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            gradient = chance(float(w.sum())) - label
            step = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / alpha
            z[at] += gradient - step * w
            n[at] += gradient * gradient
    return weights(slice(None))


def _features(docs: DataFrame) -> DataFrame:
    """(doc_id, key, toxic, features, n) of labelled rows (doc_id, key, toxic, text)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                places = [features_of(t) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array([p.tobytes() for p in places], pa.binary()),
                        pa.array([len(p) for p in places], pa.int64()),
                    ],
                    ["doc_id", "key", "toxic", "features", "n"],
                )

    return docs.select("doc_id", "key", "toxic", "text").mapInArrow(
        build, "doc_id long, key long, toxic int, features binary, n long"
    )


def draw_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = MOST) -> DataFrame:
    """(place, toxic, features) of the sampled rows, numbered in hash order.

    ``docs`` has (doc_id, text), ``labels`` (doc_id, toxic) of the rows that may teach.
    """
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    drawn = staged(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxic-labels")
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text"
    )
    # ``sample`` bounds both sides that are broadcast here
    once = _features(marked.join(F.broadcast(drawn), "doc_id")).groupBy("doc_id", "key", "toxic").agg(
        F.first("features").alias("features"), F.first("n").alias("n")
    )
    stored = staged(once, "toxic-features")
    # one id may stand on any number of rows, so the rows are cut to the bound as well
    order = [F.xxhash64("doc_id", "key"), F.col("doc_id"), F.col("key")]
    first = stored.select("doc_id", "key", "n").orderBy(*order).limit(sample)
    numbered = staged(
        first.select(
            "doc_id",
            "key",
            F.row_number().over(W.orderBy(*order)).alias("place"),
            F.sum("n").over(W.orderBy(*order)).alias("upto"),
        ).where(F.col("upto") <= most),
        "toxic-sample",
    )
    return stored.join(F.broadcast(numbered), ["doc_id", "key"]).select("place", "toxic", "features")


def fit(sample: DataFrame, least: int = LEAST, epochs: int = EPOCHS, rates: Rates = Rates()) -> Weights:
    """The non-zero weights learned from the rows (place, toxic, features) of a bounded sample."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        held = np.zeros((len(GAPS) + 1) << PLACES, np.uint8)
        for batch in batches:
            for toxic, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.append(np.frombuffer(raw, np.uint32).copy())
                labels.append(toxic)
                held[rows[-1]] = np.minimum(held[rows[-1]], least - 1) + 1
        among = np.flatnonzero(held >= least).astype(np.uint32)
        del held
        for i, row in enumerate(rows):
            rows[i] = present(row, among)
        found = ftrl(rows, labels, len(among), epochs, rates)
        some = np.flatnonzero(found[:-1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(among[some].astype(np.int64), -1)),
                pa.array(np.append(found[some], found[-1])),
            ],
            ["place", "weight"],
        )

    walked = sample.coalesce(1).sortWithinPartitions("place").select("toxic", "features")
    found = staged(walked.mapInArrow(learn, "place long, weight double"), "toxic-weights")
    rows = found.orderBy("place").collect()
    if not rows:
        return Weights(np.zeros(0, np.uint32), np.zeros(0), 0.0)
    return Weights(
        np.array([r.place for r in rows[1:]], np.uint32),
        np.array([r.weight for r in rows[1:]], np.float64),
        rows[0].weight,
    )


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, score) of every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, intercept = shared.value
        for batch in batches:
            margins = [
                intercept + float(values[present(features_of(t), places)].sum())
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([chance(m) for m in margins], pa.float64())],
                ["doc_id", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        judge, "doc_id long, score double"
    )


def held_out(doc_id: Column) -> Column:
    """Every third document by checksum of its id teaches nothing."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    texts = docs.select("doc_id", "text")
    teaching = labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    scored = score(texts, fit(draw_sample(texts, teaching, sample)))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
