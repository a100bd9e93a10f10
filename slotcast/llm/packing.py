"""Packing documents into token sequences: first-fit decreasing in random groups.

Documents are encoded, ended with an end id and cut at every ``capacity`` ids. The pieces
are dealt by a hash into groups whose number follows from the bytes of the corpus, so a
group holds about ``GROUP_BYTES`` of text whatever the corpus; the pieces of one long
document go to different groups. Each group is packed on its own: pieces in descending
length, each into the first sequence with room, found in a tournament tree over the free
room of the sequences. Ids travel once, as two-byte integers where the vocabulary allows.

Defined cases: a null text is an empty one and yields the end id alone. Rows are packed
one by one, so repeated rows and null document ids are packed as often as they occur.
Ties in length are decided by document id, start and content. No text may be lost: the
pieces of all sequences are exactly the ids of all documents.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import fresh
from slotcast.llm.tokens import word_encoder

CAPACITY = 4096
#: Text bytes of one packing group; a group is held in memory by one task.
GROUP_BYTES = 8 << 20
ROW_BYTES = 64

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
PLACED = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long,"
    " ids binary"
)


class Bins:
    """A tournament tree over the free room of ``leaves`` bins; the root has the most room."""

    def __init__(self, leaves: int, capacity: int):
        self.first = 1 << max(0, leaves - 1).bit_length()
        self.room = [capacity] * (2 * self.first)
        self.capacity = capacity

    def place(self, size: int) -> tuple[int, int]:
        """Put an item into the first bin with room; (bin, offset in it)."""
        room, node = self.room, 1
        if room[1] < size:
            raise ValueError(f"no bin has room for {size}")
        while node < self.first:
            node *= 2
            if room[node] < size:
                node += 1
        offset = self.capacity - room[node]
        room[node] -= size
        place = node - self.first
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return place, offset


def first_fit_decreasing(sizes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) of each size; ``sizes`` must be in descending order."""
    bins = Bins(len(sizes), capacity)
    return [bins.place(s) for s in sizes]


def encode_documents(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces (``PIECES``) of every row of ``docs``; ``vocabulary`` is a file path."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(shared.value)
        end, width = array(encoder.code, [end_id]).tobytes(), array(encoder.code).itemsize
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encoder.encode(text or "") + end
                n = len(ids) // width
                for start in range(0, n, capacity):
                    piece = ids[start * width : (start + capacity) * width]
                    row = (doc_id, start, len(piece) // width, n, piece)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in rows[:4]), pa.array(rows[4], pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


def pack_pieces(pieces: DataFrame, groups: int, capacity: int = CAPACITY, seed: int = 11) -> DataFrame:
    """Place pieces (``PLACED``); ``ids`` becomes little-endian four-byte integers."""
    group = fresh("_group", pieces.columns)

    def pack(table: pa.Table) -> pa.Table:
        length = table["length"].to_numpy()
        ids = table["ids"].combine_chunks()
        by = [(name, "descending" if name == "length" else "ascending") for name in
              ("length", "doc_id", "start", "ids")]
        order = pa.compute.sort_indices(table, sort_keys=by).to_numpy()
        placed = np.empty((len(order), 2), dtype=np.int64)
        placed[order] = first_fit_decreasing(length[order].tolist(), capacity)
        base = table[group][0].as_py() << 32
        wide = [
            np.frombuffer(x, f"<u{len(x) // n}").astype("<u4").tobytes()
            for x, n in zip(ids.to_pylist(), length.tolist(), strict=True)
        ]
        return pa.table(
            {
                **{c: table[c] for c in ("doc_id", "start", "length", "doc_tokens")},
                "sequence_id": pa.array(base + placed[:, 0]),
                "offset": pa.array(placed[:, 1]),
                "ids": pa.array(wide, pa.binary()),
            }
        )

    # the row number keeps repeated rows from meeting in one group; it follows the order of
    # the input files, so a task run again deals its rows out alike
    number = F.monotonically_increasing_id()
    dealt = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", number), F.lit(groups))
    return pieces.withColumn(group, dealt).groupBy(group).applyInArrow(pack, PLACED)


def group_count(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> int:
    """Groups of about ``group_bytes`` of text each; a row counts as ``ROW_BYTES`` more,
    so that any number of short or empty texts is dealt out too.
    """
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    return max(1, round(total / group_bytes))


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """All documents as pieces placed in sequences of at most ``capacity`` ids."""
    pieces = encode_documents(docs, vocabulary, end_id, capacity)
    return pack_pieces(pieces, group_count(docs, group_bytes), capacity)
