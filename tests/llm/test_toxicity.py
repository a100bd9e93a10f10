from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from slotcast.llm import queries, toxicity

LABELS = "doc_id long, toxic int"


def naive_ftrl(rows, labels, size, epochs, rates):
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        bound = 0.0 if i == size else rates.l1
        if abs(z[i]) <= bound:
            return 0.0
        return -(z[i] - math.copysign(bound, z[i])) / ((rates.beta + math.sqrt(n[i])) / rates.alpha + rates.l2)

    for _ in range(epochs):
        for row, label in zip(rows, labels):
            at = [*row, size]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for i in at:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / rates.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return [weight(i) for i in range(size + 1)]


@pytest.mark.parametrize("rates", [toxicity.Rates(), toxicity.Rates(0.5, 1.0, 1.0, 0.2)])
def test_learner_equals_the_coordinatewise_one(rates):
    random = np.random.default_rng(3)
    rows = [np.flatnonzero(random.random(30) < 0.2) for _ in range(80)]
    labels = [int(3 in r or 7 in r) for r in rows]
    have = toxicity.ftrl(rows, labels, 30, 3, rates)
    assert np.allclose(have, naive_ftrl(rows, labels, 30, 3, rates), rtol=1e-9, atol=1e-12)
    assert (have[:30] == 0).any() and have[3] > 0 and have[7] > 0


def test_features_are_words_and_pairs_with_gaps():
    a = toxicity.features_of("One two, THREE\nfour")
    assert len(a) == 4 + 3 + 2 + 1
    assert set(toxicity.features_of("one TWO")) < set(a)
    assert set(toxicity.features_of("two four")) - set(a)  # neighbours here, one word between there
    assert len(toxicity.features_of("x x x x")) == 4
    assert len(toxicity.features_of(None)) == len(toxicity.features_of(" .,\n")) == 0
    assert list(toxicity.present(np.array([1, 5, 9], np.uint32), np.array([5, 8, 9], np.uint32))) == [0, 2]


@pytest.fixture(scope="module")
def taught(make_docs, spark):
    """300 texts of which those with a certain word are toxic, and odd rows."""
    random = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(300):
        words = list(random.choice(plain, random.integers(5, 40)))
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(int(random.integers(0, len(words))), "Vile")
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(1000, None), (1001, ""), (None, "vile w1"), (None, None), (1002, "vile " * 50_000), (3, rows[3][1])]
    labels += [(None, 1), (2000, None), (5, None), (2, 0)]
    return make_docs(rows), spark.createDataFrame(labels, LABELS), rows


def scored(docs, labels, **more):
    return [tuple(r) for r in toxicity.score_toxicity(docs, labels, **more).collect()]


def test_held_out_rows_and_odd_rows(taught):
    docs, labels, rows = taught
    have = scored(docs, labels)
    assert len(have) == len(rows)
    for doc_id, held, score, predicted in have:
        assert held == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= score <= 1 and predicted == int(score >= 0.7)
    held = {d: p for d, h, _, p in have if h and d is not None and d < 300}
    assert len(held) > 60
    assert all(p == int(d % 4 == 0) for d, p in held.items())
    by_id = {d: s for d, _, s, _ in have}
    assert by_id[1002] > 0.7 and by_id[1000] == by_id[1001] < 0.5


def test_result_does_not_hang_on_partitions_or_held_out_labels(taught, spark):
    docs, labels, _ = taught
    have = sorted(scored(docs, labels), key=str)
    assert have == sorted(scored(docs.repartition(13), labels.repartition(7)), key=str)
    flipped = labels.selectExpr(
        "doc_id", "if(coalesce(crc32(cast(doc_id as string)) % 3 = 1, false), 1 - toxic, toxic) as toxic"
    )
    assert have == sorted(scored(docs, flipped), key=str)


def test_sample_is_bounded_and_repeats_teach_once(taught, spark, make_docs):
    docs, labels, _ = taught
    sample = toxicity.draw_sample(docs, labels, sample=40)
    assert sample.count() == 40
    assert toxicity.draw_sample(docs, labels, most=100).count() < 40
    one = make_docs([(1, f"text {i}") for i in range(50)] + [(1, "text 0")] * 50)
    known = spark.createDataFrame([(1, 1), (1, 0)], LABELS)
    assert toxicity.draw_sample(one, known).count() == 50
    drawn = toxicity.draw_sample(one, known, sample=20).collect()
    assert len(drawn) == 20 and all(r.toxic == 1 for r in drawn)


def test_no_labels_one_class_and_empty_tables(taught, spark, make_docs):
    docs, labels, rows = taught
    assert {s for _, _, s, _ in scored(docs, labels.limit(0))} == {0.5}
    assert all(p == 0 for *_, p in scored(docs, labels.where("toxic = 0")))
    assert scored(make_docs([]), labels) == []


def test_clashing_columns(taught):
    docs, labels, _ = taught
    odd = docs.selectExpr("*", "1 as toxic", "2 as key", "3 as features", "4 as place", "5 as score", "6 as n")
    assert sorted(scored(odd, labels.selectExpr("*", "'x' as text", "1 as upto")), key=str) == sorted(
        scored(docs, labels), key=str
    )


def test_query(spark, sf_dir):
    have = queries.QUERIES["op11_toxicity"](spark, sf_dir)
    assert have.columns == ["doc_id", "held_out", "score", "predicted"]
    assert have.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
