from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from slotcast.llm import mixing, quality, surrogates

WS = re.compile(r"[^\x20\x09-\x0D]+")


def naive_base(text):
    words = WS.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    n = len(words)
    return (n, sum(map(len, words)), symbols, dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def naive_grams(text, buckets):
    words = [w.encode() for w in WS.findall(text or "")]
    one = [xxhash.xxh64_intdigest(w, 42) for w in words]
    two = [xxhash.xxh64_intdigest(w, seed) for w, seed in zip(words[1:], one, strict=False)]
    return [signed(h) % buckets for h in one + two]


def naive_scores(docs, trusted, buckets):
    raw, tgt = Counter(), Counter()
    for doc_id, text in docs:
        grams = naive_grams(text, buckets)
        raw.update(grams)
        if doc_id in trusted:
            tgt.update(grams)
    if not tgt:
        return [0.0] * len(docs)
    a = quality.SMOOTHING
    total = [sum(c.values()) + a * buckets for c in (raw, tgt)]
    ratio = {b: math.log((tgt[b] + a) / total[1]) - math.log((raw[b] + a) / total[0]) for b in raw}
    return [sum(ratio[g] for g in gr) / len(gr) if (gr := naive_grams(t, buckets)) else 0.0 for _, t in docs]


def test_quality_against_brute_force(spark, sf_dir, sf_docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    docs = [(r.doc_id, r.text) for r in sf_docs.collect()]
    scores = dict(zip([d for d, _ in docs], naive_scores(docs, trusted, quality.BUCKETS), strict=True))
    for r in quality.quality_rules(sf_docs, labels).collect():
        base = naive_base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        assert math.isclose(r.score, scores[r.doc_id], abs_tol=1e-9)
        assert r.kept == (not base[-1] and r.score >= quality.THRESHOLD)


def test_quality_keeps_the_good_and_drops_junk(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality_rules(docs, labels).where("not base_failed").join(labels, "doc_id")
    kept = {r.quality: (r.kept, r.n) for r in judged.groupBy("quality").agg(
        F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert kept[1][0] == kept[1][1]
    assert kept[0][0] <= 0.25 * kept[0][1]


def test_quality_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "a\n\na\n a\na b c a b c"), (3, "a\n\na\n a\na b c a b c"), (None, "x " * 80), (5, "a b\x0bc\x0cd\re")]
    docs = make_docs(rows).withColumn("_words", F.lit("clash")).withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame([(3, 1, None), (3, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_rules(docs, labels, buckets=64).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == naive_base(r.text)
    empty = quality.quality_rules(docs, labels.limit(0), buckets=64).collect()
    assert {r.score for r in empty} == {0.0}
    assert quality.quality_rules(docs.limit(0), labels, buckets=64).count() == 0


def naive_targets(sizes, weights=(1, 2, 3)):
    """Share by weight, stop at three times the size, reshare the excess until none is above."""
    order = sorted(k for k in sizes if k is not None) + [k for k in sizes if k is None]
    weight = {k: weights[i % 3] for i, k in enumerate(order)}
    target, free, left = {}, list(order), sum(sizes.values())
    while free:
        level = left / sum(weight[k] for k in free)
        full = [k for k in free if level * weight[k] > 3 * sizes[k]]
        if not full:
            return target | {k: level * weight[k] for k in free}
        for k in full:
            target[k] = 3.0 * sizes[k]
            left -= target[k]
            free.remove(k)
    return target


def test_mixing_targets(make_docs):
    rnd = random.Random(2)
    rows = []
    for s, n in (("a", 400), ("b", 3), ("c", 60), (None, 40), ("Z", 1), ("é", 5)):
        rows += [(len(rows) + i, "w " * rnd.randrange(1, 60), s) for i in range(n)]
    rows += [(9999, None, "empty"), (None, "x y", "a")]
    docs = make_docs(rows).withColumn("size", F.lit("clash")).withColumn("_side_source", F.lit(0))
    plan = mixing.mixing_plan(docs).collect()
    sizes = Counter()
    for _, text, s in rows:
        sizes[s] += len((text or "").split())
    want = naive_targets(sizes)
    taken = Counter()
    for r in plan:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.copies <= 3 and math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1
        taken[r.source] += r.size * r.copies
    assert abs(taken["a"] - want["a"]) < 0.15 * want["a"] + 60
    assert sorted(map(str, plan)) == sorted(map(str, mixing.mixing_plan(docs).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in plan)
    assert mixing.mixing_plan(docs.limit(0)).count() == 0


def luhn(s):
    digits = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


TEXTS = [
    "Write to jo.doe7@mail.example.com or JO.DOE7@MAIL.EXAMPLE.COM today",
    "jo.doe7@mail.example.com again, and ann@x.org",
    "call +1 (152) 555-8590 or 152-555-8590, ssn 123-45-6789",
    "card 4111111111111111 and 4111 1111 1111 1111, not 4111111111111112",
    "from 10.20.30.40, not 1.2.3 nor 300.1.1.1",
    "iban DE89 3704 0044 0532 0130 00 here",
    "Mary Smith met JOHN SMITH; Mr Smith and Мария Петрова came, Иван stayed",
    "nothing personal here: 2024, 3.14 and 15 words",
    None,
    "",
]


def test_surrogates(make_docs):
    docs = make_docs(TEXTS).withColumn("_found", F.lit("clash")).withColumn("n_entities", F.lit("clash"))
    out = surrogates.replace_entities(docs)
    assert out.columns == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    new = {r.doc_id: (r.text, r.n_entities) for r in out.collect()}
    assert [new[i] for i in (7, 8, 9)] == [(TEXTS[7], 0), (None, 0), ("", 0)]
    mail = re.findall(r"\S+@\S+", new[0][0])
    assert mail[1] == mail[0].upper() and mail[0] in new[1][0]
    assert len(set(re.findall(r"\S+@\S+", new[1][0].replace(",", "")))) == 2
    assert all(m.lower().endswith(".example") for m in mail)
    phone = re.fullmatch(r"call \+1 \((\d{3})\) (\d{3}-\d{4}) or \d{3}-\d{3}-\d{4}, ssn \d{3}-\d{2}-\d{4}", new[2][0])
    assert phone and "555-8590" not in new[2][0] and "123-45-6789" not in new[2][0]
    a, b = re.fullmatch(r"card (4\d{15}) and ((?:4\d{3})(?: \d{4}){3}), not 4111111111111112", new[3][0]).groups()
    assert a == b.replace(" ", "") and luhn(a) and a != "4111111111111111" and new[3][1] == 2
    assert re.fullmatch(r"from \d+(\.\d+){3}, not 1\.2\.3 nor 300\.1\.1\.1", new[4][0]) and new[4][1] == 1
    assert re.fullmatch(r"iban DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d here", new[5][0])
    names = new[6][0]
    first, last, man, upper, again, woman, family, ivan = re.fullmatch(
        r"(\w+) (\w+) met (\w+) (\w+); Mr (\w+) and (\w+) (\w+) came, (\w+) stayed", names).groups()
    assert first in surrogates.FIRST_NAMES["latin", "f"] and first != "Mary"
    assert man.capitalize() in surrogates.FIRST_NAMES["latin", "m"] and man.isupper() and man != "JOHN"
    assert upper == last.upper() and again == last != "Smith"
    assert woman in surrogates.FIRST_NAMES["cyrillic", "f"] and ivan in surrogates.FIRST_NAMES["cyrillic", "m"]
    assert re.fullmatch("[А-Я][а-я]+", family) and family != "Петрова"
    other = {r.doc_id: r.text for r in surrogates.replace_entities(docs, key="other").collect()}
    assert other[0] != new[0][0]
    assert surrogates.replace_entities(docs.limit(0)).count() == 0


def test_surrogates_stay_distinct(spark, make_docs):
    """Draws from a small range collide, and every value still gets its own surrogate."""
    values = [("ssn", f"{i:02d}") for i in range(20)]
    frame = spark.createDataFrame(values, "kind string, value string")
    given = surrogates.assign(frame).collect()
    assert len(given) == len({r.surrogate for r in given}) == 20
    assert not {r.surrogate for r in given} & {v for _, v in values}
    docs = make_docs([(1, "a 10.0.0.1"), (1, "a 10.0.0.1"), (None, "b 10.0.0.1 10.0.0.2"), (None, None)])
    texts = [r.text for r in surrogates.replace_entities(docs).orderBy("text").collect()]
    assert texts[1] == texts[2] and texts[1].split()[1] == texts[3].split()[1] != texts[3].split()[2]


def test_surrogates_of_more_forms(make_docs):
    """Forms of numbers that were left in the text, and one value for a number with and without +1."""
    forms = [
        "555 123 4567", "030 1234567", "06 12 34 56 78", "2223 0031 2200 3222", "3782 822463 10005",
        "2001:db8::8a2e:370:7334", "fdaa::b", "2001:0DB8:0:0:0:8A2E:0370:7334",
    ]
    texts = [f"it is {form} today" for form in forms]
    texts += ["a +1 555-123-4567 b 555-123-4567 c (555) 123-4567", "Mr  Zwingli spoke", "at 12:34:56 std::dec ratio 1:2"]
    out = {r.doc_id: r for r in surrogates.replace_entities(make_docs(texts)).collect()}
    assert [out[i].n_entities for i in range(len(texts))] == [1] * 8 + [3, 1, 0]
    new = [out[i].text.removeprefix("it is ").removesuffix(" today") for i in range(8)]
    assert not set(new) & set(forms)
    assert [re.sub("[0-9]", "9", x) for x in new[:5]] == [re.sub("[0-9]", "9", x) for x in forms[:5]]
    assert new[1][0] == new[2][0] == "0" and new[5] == new[7] != new[6] and new[5].startswith("2001:0db8:")
    assert "Zwingli" not in out[9].text and out[10].text == texts[10]
    numbers = re.sub("[^0-9abc]", "", out[8].text)
    with_code, bare, round_ = re.fullmatch("a(.*)b(.*)c(.*)", numbers).groups()
    assert with_code == "1" + bare and bare == round_ == re.sub("[^0-9]", "", new[0]) != "5551234567"


def test_equal_rows_are_drawn_one_by_one(make_docs, spark):
    rows = [(5, "one two three four", "a")] * 400 + [(None, "x y", "a")] * 60 + [(i + 10, "w " * 300, "b") for i in range(20)]
    docs = make_docs(rows)
    plan = mixing.mixing_plan(docs.repartition(7))
    have = plan.groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")
    ).collect()
    for r in have:
        assert abs(r.taken - r.target) <= max(0.15 * r.target, 600)
    assert sorted(map(str, plan.select("doc_id", "copies").collect())) == sorted(
        map(str, mixing.mixing_plan(docs.coalesce(1)).select("doc_id", "copies").collect())
    )
    assert len({r.copies for r in plan.where("doc_id = 5").collect()}) == 2
    odd = docs.selectExpr("*", "1 as _nth", "2 as _digest", "3 as _partition", "4 as _before", "5 as _n")
    assert mixing.mixing_plan(odd).count() == len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_many_sources_are_ranked_as_in_one_list(spark, seed):
    draw = random.Random(seed)
    names = [None] + [f"s{i:03}" for i in range(draw.choice([3, 40, 90]))]
    sizes = {n: draw.choice([0, 1, 5, 40, 1000]) for n in names}
    sized = spark.createDataFrame([(n, v) for n, v in sizes.items()] * 2, "source string, size long").repartition(5)
    have = {r.source: (r.source_size, r.target) for r in mixing.source_targets(sized).collect()}
    order = sorted(names, key=lambda n: (n is None, n))
    weight = {n: i % 3 + 1 for i, n in enumerate(order)}
    total, open_, level = 2 * sum(sizes.values()), set(names), 0.0
    capped = set()
    while open_:
        level = (total - sum(6 * sizes[n] for n in capped)) / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > 6 * sizes[n]}
        if not over:
            break
        capped |= over
        open_ -= over
    for n in names:
        want = 6 * sizes[n] if n in capped else level * weight[n]
        assert have[n][0] == 2 * sizes[n] and have[n][1] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_helper_columns_of_surrogates_clash_with_none(make_docs):
    docs = make_docs(["mail a.b@c.example to me", "nothing", None])
    want = sorted((r.doc_id, str(r.text)) for r in surrogates.replace_entities(docs).collect())
    odd = docs.selectExpr("*", *[f"{i} as {c}" for i, c in enumerate(
        ["_i", "_h", "_puts", "_put", "_hit", "_at", "_found", "_id", "_hash", "_new", "mention", "kind", "value", "surrogate"])])
    have = surrogates.replace_entities(odd)
    assert sorted((r.doc_id, str(r.text)) for r in have.collect()) == want
    assert have.columns == [*odd.columns, "n_entities"] and have.where("_i = 0 and surrogate = 13").count() == 3
