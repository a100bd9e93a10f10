from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotcast.llm import packing, tokens

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a", "the", "ing", "'s", "'RE", " ", "  ", "   ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85",
    "\u00a0", "\u2003", "é", "É", "İ", "ß", "Σ", "\u0301", "中文", "😀", "123", "²", "!!", "_",
    "<|endoftext|>", "<|startoftext|>", "<|", "\x00", "\u200b", "ſ", "K", "’",
]
pieces = st.lists(st.sampled_from(ODD), max_size=14).map("".join)


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


@pytest.fixture(scope="module")
def encoder():
    return tokens.WordEncoder(Path(WORD).read_text())


@pytest.fixture(scope="module")
def counter():
    config = Path(BYTE).read_text()
    return tokens.ByteCounter(config, tokens.whole_tokens(config))


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), encoder.code).tolist()


@settings(max_examples=1500, deadline=None)
@given(pieces)
def test_same_as_the_tokenizers(encoder, counter, library, text):
    assert ids_of(encoder, text) == library[WORD].encode(text, add_special_tokens=False).ids
    assert counter.count(text) == len(library[BYTE].encode(text, add_special_tokens=False).ids)


def test_same_on_documents(encoder, counter, library, sf_docs):
    for row in sf_docs.select("text").limit(60).collect():
        text = row.text or ""
        assert ids_of(encoder, text) == library[WORD].encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(library[BYTE].encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("path,end,mark", [(WORD, tokens.WORD_END, b"\n"), (BYTE, "", b"")])
def test_merge_rules_follow_from_ranks(path, end, mark):
    """Each token, merged from its bytes by lower ranks, ends as the pair its rule names."""
    model = json.loads(Path(path).read_text())["model"]
    ranks = tokens.ranks_of(model["vocab"], end, mark)
    letters = tokens.byte_letters()

    def raw(token):
        body = token.removesuffix(end) if end else token
        return bytes(letters[c] for c in body) + mark * (body != token)

    for rule in model["merges"]:
        a, b = rule if isinstance(rule, list) else rule.split(" ")
        want = [raw(a), raw(b)]
        top = ranks[want[0] + want[1]]
        parts = [bytes([x]) for x in want[0] + want[1]]
        while True:
            pairs = [(ranks.get(x + y, top), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False))]
            best = min(pairs, default=(top, 0))
            if best[0] >= top:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert parts == want, rule


def test_whole_tokens_are_single(counter, library):
    some = sorted(counter.whole)[::997]
    assert all(len(library[BYTE].encode(t, add_special_tokens=False).ids) == 1 for t in some)


def test_token_counts_edges(make_docs):
    docs = make_docs([(1, None), (1, ""), (None, "a b"), (2, "x " * 600), (2, "x " * 600)])
    rows = sorted(map(tuple, tokens.token_counts(docs.withColumn("n_tokens", F.lit(1)), BYTE).collect()), key=str)
    assert rows == sorted(
        [(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, False)] + [(2, 1200, 601, True)] * 2, key=str
    )
    assert tokens.token_counts(docs.limit(0), BYTE).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(sizes):
    sizes = sorted(sizes, reverse=True)
    bins: list[int] = []
    want = []
    for s in sizes:
        place = next((i for i, used in enumerate(bins) if used + s <= 64), len(bins))
        if place == len(bins):
            bins.append(0)
        want.append((place, bins[place]))
        bins[place] += s
    assert packing.first_fit_decreasing(sizes, 64) == want


def check_packed(rows, texts, library, capacity):
    """An exact round trip: every id of every document once, sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, ids.tolist(), r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    have = Counter()
    for doc_id, parts in by_doc.items():
        by_start = defaultdict(list)
        for start, ids, n in parts:
            by_start[start].append((ids, n))
        for n in {n for _, _, n in parts}:
            have[doc_id] += sum(len(i) for _, i, m in parts if m == n) // n
    want = Counter(doc_id for doc_id, _ in texts)
    assert have == want
    for doc_id, text in texts:
        if want[doc_id] == 1:
            ids = [i for _, part, _ in sorted(by_doc[doc_id]) for i in part]
            assert ids == library[WORD].encode(text or "", add_special_tokens=False).ids + [2]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_round_trip(sf_docs, library):
    packed = packing.pack_documents(sf_docs, WORD, group_bytes=200_000).collect()
    texts = [(r.doc_id, r.text) for r in sf_docs.collect()]
    check_packed(packed, texts, library, 4096)
    used = sum(r.length for r in packed)
    assert used > 0.95 * 4096 * len({r.sequence_id for r in packed})
    assert len({r.sequence_id >> 32 for r in packed}) > 1


def test_packing_edges(make_docs, library):
    rows = [(1, None), (2, ""), (3, "word " * 500), (4, "a"), (4, "a"), (None, "x y z")]
    docs = make_docs(rows).withColumn("_group", F.lit(9)).withColumn("ids", F.lit("clash"))
    packed = packing.pack_documents(docs, WORD, capacity=64)
    check_packed(packed.collect(), rows, library, 64)
    first = {(r.doc_id, r.start): (r.sequence_id, r.offset) for r in packed.collect() if r.doc_id == 3}
    again = {(r.doc_id, r.start): (r.sequence_id, r.offset) for r in packed.collect() if r.doc_id == 3}
    assert first == again
    crc = packed.where("doc_id = 1").select(F.crc32("ids")).first()[0]
    assert crc == zlib.crc32((2).to_bytes(4, "little"))
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0


def test_short_texts_are_dealt_to_groups_too(make_docs):
    docs = make_docs([None, "", "x"] * 50)
    assert packing.group_count(docs, group_bytes=10 * packing.ROW_BYTES) == 15
