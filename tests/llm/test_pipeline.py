from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
import test_duplicates
import test_tokens_packing
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotcast.llm import mixing, quality, secrets
from slotcast.llm.oracles import ORACLES
from slotcast.llm.queries import QUERIES


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages_on_documents(spark, sf_dir, sf_docs):
    """Each stage against a plain version, on what its predecessor kept."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard_join", "secret_scans", "source_mixing", "packing"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    good = stages["quality_rules"](spark, sf_docs, sf_dir)
    ruled = quality.quality_rules(sf_docs, labels).where("kept")
    assert ids(good) == ids(ruled) and 0 < good.count() < sf_docs.count()

    single = stages["ngram_jaccard_join"](spark, good, sf_dir)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    roots = test_duplicates.naive_components(rows, 5, 80)
    assert ids(single) == sorted({root for _, root in roots.values()}, key=str)

    masked = stages["secret_scans"](spark, single, sf_dir)
    before = {r.doc_id: r for r in single.collect()}
    import re

    allowed = [re.compile(a) for a in secrets.ALLOWED]
    for r in masked.collect():
        old = before.pop(r.doc_id)
        want = secrets.redacted(old.text, secrets.spans_of(old.text, allowed), "[secret]")
        assert r.text == want and (r.n_chars == old.n_chars if want == old.text else len(want))
    assert not before

    mixed = stages["source_mixing"](spark, masked, sf_dir)
    plan = Counter({r.doc_id: r.copies for r in mixing.mixing_plan(masked).collect()})
    assert Counter(ids(mixed)) == +plan

    packed = stages["packing"](spark, mixed, sf_dir)
    library = {p: Tokenizer.from_file(p) for p in (test_tokens_packing.WORD,)}
    texts = [(r.doc_id, r.text) for r in mixed.collect()]
    test_tokens_packing.check_packed(packed.collect(), texts, library, 4096)
    for df in (good, single, masked, mixed):
        assert df.columns == sf_docs.columns and df.dtypes == sf_docs.dtypes


def test_stages_on_odd_rows(spark, sf_dir, make_docs):
    text = " ".join(f"word{i}" for i in range(60))
    docs = make_docs([(1, text), (1, text), (2, text + " more"), (None, None), (None, None), (3, ""), (4, "é " * 70)])
    stages = dict(corpus_pipeline.STAGES)
    left = stages["ngram_jaccard_join"](spark, docs, sf_dir)
    assert ids(left) == sorted([1, 3, 4, None], key=str)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() >= 0
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_near_duplicates_go_by_row_not_by_id(spark, sf_dir, make_docs):
    texts = [" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcdefgh"]
    a, b, c, d, e, f, g, h = texts
    rows = [
        (1, a), (None, a + " more"), (None, b), (None, c),  # a copy without an id, clean rows without
        (2, d), (3, d + " more"), (3, e),  # one id, one of its two texts a copy
        (None, f), (None, f + " more"), (None, f),  # near copies, all without an id
        (5, g), (5, g + " more"), (5, g),  # near copies that share an id
        (None, None), (None, None), (None, ""), (6, h), (6, h),
    ]
    docs = make_docs(rows).withColumn("_text_hash", F.lit("kept"))
    left = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, sf_dir)
    assert left.columns == docs.columns
    have = Counter((r.doc_id, (r.text or "")[:2], r.text is None) for r in left.collect())
    assert have == Counter(
        [(1, "a0", False), (None, "b0", False), (None, "c0", False), (2, "d0", False), (3, "e0", False),
         (None, "f0", False), (5, "g0", False), (None, "", True), (None, "", False), (6, "h0", False)]
    )


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset", "ids"} <= set(rows.columns)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = sorted(result.fetchall(), key=str)
    got = QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == want
