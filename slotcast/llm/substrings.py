"""Substring dedup: Rabin-Karp hashes of every fixed-length window of words.

A window of ``length`` words is removed from where it stands if the same words also start
anywhere else. All windows of all texts are judged on the input; the removed windows of a
text merge into maximal intervals of words.

1. Anchors. Every window has an anchor, the least of the hashes of its runs of about half
   its length, so equal windows have equal anchors, and neighbouring windows mostly share
   theirs. The distinct anchors of each text are counted. A window whose anchor occurs
   once in the corpus occurs once itself and is settled.
2. Windows. All other windows get a rolling polynomial (Rabin-Karp) hash of their words,
   and the hashes are counted.

Both counts are a shuffle on the hash, after each batch has settled what repeats inside it
and sends one row of that on.
3. Intervals. Repeated windows come back to their text as intervals.

So a passage that a third of all documents share is one row per batch in each shuffle.

Defined cases: a null text has no words. Texts shorter than a window lose nothing. Rows
are told apart by document id and text; exact repeats of a row are copies of each other
and lose their repeated windows alike. Extra columns are kept. Two windows are taken as
equal if their 64-bit hashes collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.llm.common import fresh
from slotcast.llm.tokens import Remembered

U64 = np.uint64
#: Odd base of the polynomial; arithmetic is modulo 2**64 over scrambled word hashes.
BASE = 0x5851F42D4C957F2D
#: In place of the end of a window that is still counted: one place, or two or more.
COUNTED, SENT = -1, -2
#: Windows that a task holds before it sends them on.
HELD = 400_000


@lru_cache(maxsize=1)
def word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(word_hashes().__getitem__, words), dtype=U64, count=len(words))


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``length`` words.

    With P[j] the hash of the first j words, a window's hash is P[i + n] - P[i] B**n. The
    hashes of runs of 1, 2, 4 ... words are combined to the wanted length, which is the
    same polynomial without a loop over words.
    """
    count = len(ids) - length + 1
    if count <= 0:
        return np.zeros(0, U64)
    done, done_length, run, run_length, rest = None, 0, ids, 1, length
    while True:
        if rest & 1:
            if done is None:
                done = run
            else:
                n = len(ids) - done_length - run_length + 1
                done = done[:n] * U64(pow(BASE, run_length, 1 << 64)) + run[done_length : done_length + n]
            done_length += run_length
        rest >>= 1
        if not rest:
            return scrambled(done[:count])
        n = len(ids) - 2 * run_length + 1
        run = run[:n] * U64(pow(BASE, run_length, 1 << 64)) + run[run_length : run_length + n]
        run_length *= 2


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    return x ^ (x >> U64(29))


def window_anchors(runs: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every window: the least of the hashes of its runs of half its length."""
    span = length - run_length(length) + 1
    count = len(runs) - span + 1
    if count <= 0:
        return np.zeros(0, U64)
    least, width = runs, 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    return np.minimum(least[:count], least[span - width : span - width + count])


def run_length(length: int) -> int:
    return (length + 1) // 2


def merged(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal intervals of words covered by windows at the ascending ``starts``."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    first = np.concatenate([[0], gap + 1])
    last = np.concatenate([gap, [len(starts) - 1]])
    return list(zip(starts[first].tolist(), (starts[last] + length).tolist(), strict=True))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64, copy=False).view(np.int64))


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(_id, _hash, anchors): per text, its anchors that occur more than once anywhere."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
            times = [np.zeros(0, np.int64)]
            for i, text in enumerate(batch.column(2).to_pylist()):
                runs = rolling(word_ids(split_words(text)), run_length(length))
                distinct = np.unique(window_anchors(runs, length))
                if len(distinct):
                    # every place of the run counts, also one beside another
                    values, n = np.unique(runs, return_counts=True)
                    found.append(distinct)
                    times.append(n[np.searchsorted(values, distinct)])
                    rows.append(np.full(len(distinct), i))
            anchor, row, n = map(np.concatenate, (found, rows, times))
            order = np.argsort(anchor, kind="stable")
            anchor, row, n = anchor[order], row[order], n[order]
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])[: len(anchor)]
            places = np.bincount(np.cumsum(new) - 1, n) if len(n) else n
            many = (places > 1)[np.cumsum(new) - 1]
            # what repeats in this batch is settled; one row speaks for it elsewhere
            row = np.concatenate([row, row[many & new]])
            take = pa.array(row)
            state = np.concatenate([np.where(many, 0, COUNTED), np.full((many & new).sum(), SENT)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 _signed(np.concatenate([anchor, anchor[many & new]])),
                 pa.array(state.astype(np.int32))],
                ["_id", "_hash", "anchor", "state"],
            )

    places = docs.select("_id", "_hash", "text").mapInArrow(
        anchors, "_id long, _hash long, anchor long, state int"
    )
    # settled rows are spread by their text, so that no anchor gathers them
    settled = F.col("state") == 0
    same = W.partitionBy("anchor", F.when(settled, F.hash("_id", "_hash")))
    return (
        places.withColumn("_total", F.sum(-F.col("state")).over(same))
        .where(settled | ((F.col("state") == COUNTED) & (F.col("_total") > 1)))
        .groupBy("_id", "_hash")
        .agg(F.collect_list("anchor").alias("anchors"))
    )


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(_id, _hash, start, stop): intervals of words that repeated windows cover.

    ``docs`` holds (_id, _hash, text, anchors).
    """

    def settle(ids: list, hashes: list, starts: list) -> pa.RecordBatch:
        """Rows to send on for some texts: ``ids`` has (_id, _hash) per text."""
        row = np.repeat(np.arange(len(ids)), [len(x) for x in hashes])
        h, start = np.concatenate(hashes), np.concatenate(starts)
        order = np.argsort(h, kind="stable")
        h, start, row = h[order], start[order], row[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
        group = np.cumsum(new) - 1
        many = (np.bincount(group) > 1)[group] if len(h) else new
        # what repeats here is settled here; its first row speaks for it elsewhere
        back = np.lexsort((start[many], row[many]))
        r, s = row[many][back], start[many][back]
        own = [
            (int(part[0]), a, b)
            for part, places in zip(
                np.split(r, np.flatnonzero(np.diff(r)) + 1),
                np.split(s, np.flatnonzero(np.diff(r)) + 1),
                strict=True,
            )
            if len(part)
            for a, b in merged(places, length)
        ]
        sent = np.flatnonzero(~many | new)
        texts = np.concatenate([row[sent], np.array([o[0] for o in own], np.int64)])
        state = np.where(many[sent], SENT, COUNTED)
        # settled intervals go to keys that spread them; they are told apart by their stop
        spread = scrambled(np.arange(len(own), dtype=U64) + U64(len(h)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i][0] for i in texts], pa.int64()),
                pa.array([ids[i][1] for i in texts], pa.int64()),
                _signed(np.concatenate([h[sent], spread])),
                pa.array(np.concatenate([start[sent], np.array([o[1] for o in own], np.int64)])),
                pa.array(np.concatenate([state, np.array([o[2] for o in own], np.int64)])),
            ],
            ["_id", "_hash", "window", "start", "stop"],
        )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, starts, held = [], [], [], 0
        for batch in batches:
            for _id, _hash, text, anchors in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = word_ids(split_words(text.as_py()))
                wanted = np.asarray(anchors.values, dtype=np.int64).view(U64)
                found = window_anchors(rolling(words, run_length(length)), length)
                at = np.flatnonzero(np.isin(found, wanted))
                ids.append((_id.as_py(), _hash.as_py()))
                hashes.append(rolling(words, length)[at])
                starts.append(at)
                held += len(at)
                if held >= HELD:
                    yield settle(ids, hashes, starts)
                    ids, hashes, starts, held = [], [], [], 0
        if ids:
            yield settle(ids, hashes, starts)

    rows = docs.select("_id", "_hash", "text", "anchors").mapInArrow(
        windows, "_id long, _hash long, window long, start long, stop long"
    )
    settled = F.col("stop") > 0
    same = W.partitionBy("window", settled)
    return (
        rows.withColumn("_total", F.sum(-F.col("stop")).over(same))
        .where(settled | ((F.col("stop") == COUNTED) & (F.col("_total") > 1)))
        .select(
            "_id",
            "_hash",
            "start",
            F.when(settled, F.col("stop")).otherwise(F.col("start") + length).alias("stop"),
        )
    )


def packed(start: Column, stop: Column) -> Column:
    """An interval of words as one integer, which keeps the lists of a text small."""
    return F.shiftleft(start, 32) + (stop - start)


def _kept(words: list[bytes], intervals: list[int] | None) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words outside the intervals, and the intervals merged."""
    joined: list[list[int]] = []
    for start, stop in sorted((s >> 32, (s >> 32) + (s & 0xFFFFFFFF)) for s in intervals or ()):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], stop)
        else:
            joined.append([start, stop])
    kept, at = [], 0
    for start, stop in joined:
        kept += words[at:start]
        at = stop
    return kept + words[at:], [(a, b) for a, b in joined]


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


@F.arrow_udf(RESULT)
def cut_out(texts: pa.Array, intervals: pa.Array) -> pa.Array:
    out: tuple[list, ...] = ([], [], [], [], [])
    for text, spans in zip(texts.to_pylist(), intervals.to_pylist(), strict=True):
        words = split_words(text)
        kept, removed = _kept(words, spans)
        joined = b" ".join(kept)
        row = (len(words), len(words) - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest(), removed)
        for column, value in zip(out, row, strict=True):
            column.append(value)
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.list_(pa.int64())))
    return pa.StructArray.from_arrays(
        [pa.array(c, t) for c, t in zip(out, types, strict=True)],
        ["n_words", "n_removed", "kept", "kept_sha256", "removed"],
    )


def remove_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """``docs`` with ``n_words, n_removed, kept, kept_sha256`` and ``removed``.

    ``kept`` is the remaining words joined by single spaces, ``removed`` the maximal
    intervals [start, stop) of words. The added columns replace columns of ``docs`` of the
    same name.
    """
    docs = docs.drop(*RESULT.fieldNames())
    key = {"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64("text")}
    cut = text_removals(docs.select("doc_id", "text"), length)
    if set(docs.columns) == {"doc_id", "text"}:
        return cut.select(F.col("_id").alias("doc_id"), "text", "_cut.*")
    once = cut.select("_id", "_hash", "_cut.*").dropDuplicates(["_id", "_hash"])
    names = {"_id": fresh("_id", docs.columns), "_hash": fresh("_hash", docs.columns)}
    keyed = docs.withColumns({names[k]: c for k, c in key.items()})
    side = {"_id": fresh("_id2", keyed.columns), "_hash": fresh("_hash2", keyed.columns)}
    right = once.withColumnsRenamed(side)
    same = F.col(names["_id"]).eqNullSafe(F.col(side["_id"])) & (F.col(names["_hash"]) == F.col(side["_hash"]))
    return keyed.join(right, same).select(*docs.columns, *RESULT.fieldNames())


def text_removals(docs: DataFrame, length: int) -> DataFrame:
    """(_id, _hash, text, _cut) of every row of (doc_id, text)."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text"
    )
    renamed = {"_id": "_id2", "_hash": "_hash2"}
    here = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_hash") == F.col("_hash2"))
    # both joins need the texts by the same key, so Spark shuffles them once
    anchors = repeated_anchors(texts, length).withColumnsRenamed(renamed)
    spans = (
        repeated_windows(texts.join(anchors, here), length)
        .groupBy("_id", "_hash")
        .agg(F.collect_list(packed(F.col("start"), F.col("stop"))).alias("_spans"))
        .withColumnsRenamed(renamed)
    )
    joined = texts.join(spans, here, "left")
    return joined.withColumn("_cut", cut_out("text", "_spans")).select("_id", "_hash", "text", "_cut")
