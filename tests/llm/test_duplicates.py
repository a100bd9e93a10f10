from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotcast.llm import components, jaccard, neighbours, substrings


def least_reached(items, links):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def naive_components(rows, words, percent):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[k + 1 :]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    roots = least_reached([i for i, _ in sets], links)
    return {i: (len(s), roots[i]) for i, s in sets}


def near_copies(seed, bases=6, copies=12, words=90):
    """Copies of base texts with a few words changed, so that similarities straddle a limit."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(bases):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 12, 30, words, 3 * words]))]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rnd.randrange(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                copy = copy[: max(1, len(copy) - rnd.randrange(8))]
            texts.append(" ".join(copy))
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("words,percent,seed", [(3, 90, 1), (5, 80, 2)])
def test_jaccard_against_brute_force(make_docs, words, percent, seed):
    rows = list(enumerate(near_copies(seed)))
    rows += [(1000, None), (1001, ""), (1002, "\t \n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, rows[0][1])]
    docs = make_docs(rows).withColumn("node", F.lit("clash")).withColumn("sig", F.lit(1))
    have = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, words, percent).collect()}
    assert have == naive_components(rows, words, percent)


def test_jaccard_repeats_nulls_and_empty(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    docs = make_docs([(5, text), (5, text), (None, text), (7, text + " x"), (8, None), (8, None), (None, None)])
    have = sorted(map(tuple, jaccard.jaccard_components(docs, 3, 90).collect()), key=str)
    assert have == sorted([(5, 38, 5), (5, 38, 5), (None, 38, 5), (7, 39, 5), (8, 0, 8), (8, 0, 8), (None, 0, None)], key=str)
    assert jaccard.jaccard_components(docs.limit(0), 3, 90).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=120), st.data(), st.sampled_from([80, 90]))
def test_qualifying_sets_share_a_signature(full, data, percent):
    """The pigeonhole argument: every pair at or above the threshold is a candidate."""
    full = sorted(full)
    gone = data.draw(st.integers(0, len(full) // 4))
    a, b = full[: len(full) - gone // 2], full[gone - gone // 2 :]
    if not a or not b or 100 * len(set(a) & set(b)) < percent * len(set(a) | set(b)) or a == b:
        return
    classes = jaccard.SizeClasses(percent)
    sigs = [set(jaccard.segment_signatures(np.array(x, np.uint64), classes).tolist()) for x in (a, b)]
    assert sigs[0] & sigs[1]


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(400, 470)]
    frame = spark.createDataFrame(links + links[:5] + [(None, 3)], "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = least_reached(nodes, [(a, b) for a, b in links if a != b])
    for size in (20, 100_000):
        rows = components.connected_components(frame, size).collect()
        assert {r.node: r.component for r in rows} == want and len(rows) == len(want)
    assert components.connected_components(frame.limit(0)).count() == 0


def naive_removal(rows, length):
    seen: dict[tuple, int] = {}
    split = [(t or "").encode().split() for _, t in rows]
    for words in split:
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc_id, _), words in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(words) - length + 1):
            if seen[tuple(words[i : i + length])] > 1:
                gone |= set(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [1, 2, 5, 8])
def test_substrings_against_brute_force(make_docs, length):
    rnd = random.Random(length)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [" ".join(rnd.choice("abcde") for _ in range(rnd.randrange(40))) for _ in range(30)]
    texts += [f"x{i} {passage} y{i}" for i in range(20)] + [passage, "a " * 30, "a " * 7, "é ü\x0bé\x0cü é ü é ü"]
    rows = list(enumerate(texts)) + [(99, None), (100, ""), (101, texts[3]), (102, texts[3])]
    docs = make_docs(rows)
    cut = substrings.remove_repeats(docs.select("doc_id", "text"), length)
    have = sorted((tuple(r) for r in cut.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert have == naive_removal(rows, length)
    for r in cut.collect():
        assert sum(b - a for a, b in r.removed) == r.n_removed
        assert all(x[1] < y[0] for x, y in zip(r.removed, r.removed[1:], strict=False))


def test_substrings_edges(make_docs, spark, monkeypatch):
    monkeypatch.setattr(substrings, "HELD", 5)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s"), (None, "z a b c d y"), (None, None)]
    docs = make_docs(rows).withColumn("_id", F.lit("clash")).withColumn("anchors", F.lit(2))
    cut = substrings.remove_repeats(docs, 4)
    have = sorted((tuple(r) for r in cut.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert have == naive_removal(rows, 4)
    assert cut.columns[: len(docs.columns)] == docs.columns
    assert substrings.remove_repeats(docs.limit(0), 4).count() == 0


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(1, 12))
def test_rolling_hash_is_the_polynomial(ids, length):
    have = substrings.rolling(np.array(ids, np.uint64), length)
    want = []
    for i in range(len(ids) - length + 1):
        h = 0
        for x in ids[i : i + length]:
            h = (h * substrings.BASE + x) % (1 << 64)
        want.append(h)
    assert have.tolist() == substrings.scrambled(np.array(want, np.uint64)).tolist()


def vector_rows(seed=9, groups=40, spread=0.3):
    """Groups of vectors around centres at cosines on both sides of 0.9."""
    rnd = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rnd.normal(size=32)
        centre /= np.linalg.norm(centre)
        for _ in range(rnd.integers(1, 9)):
            noise = rnd.normal(size=32)
            v = centre + rnd.uniform(0, spread) * noise / np.linalg.norm(noise)
            rows.append(v)
    rows += rows[:5] + [2 * rows[6]]
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


def brute_links(rows):
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(m @ m.T >= 0.9, 1))
    return list(zip(a.tolist(), b.tolist(), strict=True))


def test_recall_of_the_pivot_index(spark):
    rows = vector_rows()
    links = brute_links(rows)
    bad = [(900, None), (901, []), (902, [0.0] * 32), (903, [float("nan")] * 32), (904, [None] + [1.0] * 31), (905, [1.0] * 7)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    index = neighbours.near_duplicates(frame.withColumn("unit", F.lit(1)), block=64, single=0)
    have = {r.vec_id: r for r in index.collect()}
    found = sum(r.n_links for r in have.values()) / 2
    assert 0.9 * len(links) <= found <= len(links)
    want = least_reached(range(len(rows)), links)
    assert sum(have[i].component_id == want[i] for i in want) >= 0.9 * len(want)
    assert all(tuple(have[i])[1:] == (0, i, True) for i, _ in bad)
    assert all(r.kept == (r.vec_id == r.component_id) for r in have.values())


def test_recall_on_the_given_vectors(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    frame = spark.read.parquet(path)
    rows = [(r.vec_id, r.embedding) for r in frame.orderBy("vec_id").collect()]
    links = brute_links(rows)
    have = neighbours.near_duplicates(frame).agg(F.sum("n_links")).first()[0] / 2
    assert 0.9 * len(links) <= have <= len(links)


def test_vectors_with_small_blocks_and_edges(spark):
    rnd = np.random.default_rng(1)
    centre = rnd.normal(size=8)
    hot = [(i, [float(x) for x in centre + 0.01 * rnd.normal(size=8)]) for i in range(150)]
    frame = spark.createDataFrame(hot + [(None, hot[0][1]), (3, hot[0][1])], "vec_id long, embedding array<float>")
    rows = neighbours.near_duplicates(frame, block=16).collect()
    assert {(r.n_links, r.component_id) for r in rows} == {(151, 0)}
    assert neighbours.near_duplicates(frame.limit(0)).count() == 0


def test_texts_whose_short_hashes_collide(spark, make_docs):
    """Two texts of one id and one 32-bit hash: what is removed from one stays in the other."""
    common = " ".join(f"c{i}" for i in range(40))
    own = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: F.concat(F.lit("u"), "id", F.lit("_"), i)), " ")
    texts = spark.range(300_000).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit(f"{common} t"), "id")).otherwise(own).alias("text")
    ).withColumn("repeats", F.col("text").startswith("c"))
    pairs = texts.groupBy(F.hash("text").alias("h")).agg(
        F.max(F.when(F.col("repeats"), F.col("text"))).alias("a"), F.max(F.when(~F.col("repeats"), F.col("text"))).alias("b")
    )
    pair = pairs.where("a is not null and b is not null").first()
    docs = make_docs([(None, pair.a), (None, pair.b), (1, common)]).select("doc_id", "text")
    removed = {r.text: r.n_removed for r in substrings.remove_repeats(docs, 35).collect()}
    assert removed == {pair.a: 40, pair.b: 0, common: 40}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
def test_sketches_never_claim_too_many_differences(a, b):
    spread = [np.array(sorted((x * 0x9E3779B97F4A7C15) % 2**64 for x in s), np.uint64) for s in (a, b)]
    sketches = [jaccard.odd_sketch(x) for x in spread]
    assert jaccard.fewest_differences(*sketches) == jaccard.fewest_differences(*sketches[::-1])
    assert jaccard.fewest_differences(*sketches) <= len(a ^ b)
    assert jaccard.fewest_differences(sketches[0], sketches[0]) == 0


@pytest.mark.parametrize("block", [3, 8, 2048])
def test_blocks_of_a_signature_lose_no_pair(spark, block):
    rng = np.random.default_rng(7)
    sets, rows = {}, []
    base = rng.integers(0, 2**63, 130, dtype=np.uint64)
    for node in range(40):
        size = int(rng.choice([50, 63, 66, 120]))
        own = rng.integers(0, 2**63, int(rng.integers(0, 12)), dtype=np.uint64)
        sets[node] = np.unique(np.concatenate([base[:size], own]))
        for sig in {node % 3, 3 + node % 2}:
            rows.append((sig, node, node % 4, len(sets[node]), bytearray(jaccard.odd_sketch(sets[node]).tobytes())))
    members = spark.createDataFrame(rows, "sig long, node long, comp long, n long, odd binary")
    members = members.join(members.groupBy("sig").agg(F.count("*").alias("members")), "sig")
    found = jaccard.block_pairs(members, 80, None, block)
    have = {(r.a, r.b) for r in found.collect()}
    nearest = jaccard.block_pairs(members, 80, 1, block).collect()
    assert found.where("sig is not null").isEmpty() and any(r.sig is not None for r in nearest)
    assert {(r.a, r.b) for r in nearest if r.sig is None} < have
    for a, b in itertools.combinations(range(40), 2):
        meet = (a - b) % 3 == 0 or (a - b) % 2 == 0
        common = len(np.intersect1d(sets[a], sets[b]))
        links = 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)
        if meet and a % 4 != b % 4 and links:
            assert (a, b) in have
        if not meet or a % 4 == b % 4:
            assert (a, b) not in have


def planted(n, pairs, length, seed):
    """Random directions, the first ``pairs`` of them with a partner at cosine 0.90 to 0.95."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    a = unit(rng.normal(size=(n, length)))
    cosine = rng.uniform(0.901, 0.95, (pairs, 1))
    other = rng.normal(size=(pairs, length))
    other = unit(other - (other * a[:pairs]).sum(axis=1, keepdims=True) * a[:pairs])
    return np.concatenate([a, cosine * a[:pairs] + np.sqrt(1 - cosine**2) * other])


def test_thousands_of_pairs_at_the_threshold(spark):
    vectors = planted(9000, 3000, 64, 3)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    have = {r.vec_id: r for r in neighbours.near_duplicates(frame).collect()}
    found = sum(have[9000 + i].component_id == i for i in range(3000))
    assert found >= 0.97 * 3000
    assert all(have[i].n_links == 0 for i in range(3000, 9000))


@pytest.mark.parametrize("count", [256, 1024, 4096, 16384])
def test_permutations_keep_recall_as_pivots_grow(count):
    vectors, n = planted(1200, 1200, 64, count), neighbours.nearest_of(count)
    pivots = np.random.default_rng(1).normal(size=(count, 64))
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    order = np.argsort(-(vectors @ pivots.T), axis=1)[:, :n]
    shared = [len(np.intersect1d(order[i], order[1200 + i])) for i in range(1200)]
    assert np.mean(np.array(shared) >= neighbours.SHARED) >= 0.97


def test_vectors_link_within_their_own_length(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.1]), (5, [9.0, -1.0, 0.0]),
            (6, [3.0]), (7, [5.0]), (8, [-1.0]), (9, None), (10, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for single in (0, 1024):
        have = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(frame, single=single).collect()}
        assert have == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9), 10: (0, 10)}


def test_helper_columns_of_substrings_clash_with_none(make_docs):
    line = " ".join(f"w{i}" for i in range(50))
    docs = make_docs([line + " a", line + " b", "c", None])
    want = sorted(tuple(r) for r in substrings.remove_repeats(docs).select("doc_id", "n_removed").collect())
    odd = docs.selectExpr("*", *[f"{i} as {c}" for i, c in enumerate(["_id", "_hash", "_id2", "_hash2", "_cut", "_spans", "start", "stop"])])
    have = substrings.remove_repeats(odd)
    assert sorted(tuple(r) for r in have.select("doc_id", "n_removed").collect()) == want
    assert have.where("_id2 = 2 and stop = 7").count() == 4
