"""Token counts with the whole-token shortcut, and ids for packing.

A byte-level vocabulary holds many strings that a pre-token can equal outright. Which of
them encode alone as one token is proved once, on the driver, by encoding each of them
with the tokenizer itself (``whole_tokens``). While counting, a pre-token in that set
counts one; only the rest is merged, and remembered in a bounded table per worker.

Texts are cut at single spaces first, which keeps the remembered pieces short. That is
exact because the splitting pattern attaches a single space to what follows it; where a
space has white space on both sides, or ends the text after white space, the text goes
to the pattern whole. Pieces with characters outside the Latin blocks go to the
tokenizer as they are, because pattern engines differ in their Unicode tables.

Merging uses the vocabulary as ranks. This gives the tokenizer's result if each token,
merged from its own bytes by lower ranks alone, ends as the pair that its merge rule
names; ``tests/llm`` proves that for every rule of the vocabularies used.

Defined cases: a null text is an empty text, with 0 bytes and 0 tokens. Special strings
inside texts count one token, as the tokenizer does by default. Rows are independent, so
nulls in other columns, repeated rows and extra columns play no part.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Entries that a worker remembers before it starts again.
REMEMBERED = 200_000
#: Characters for which all pattern engines and case tables agree.
LATIN = re.compile(r"[\x00-įı-ſ‐-‧€]*")
#: A space that belongs to a longer run of white space, or ends it.
LOOSE_SPACE = re.compile(r"\s (?:\s|\Z)")
#: Splitting patterns of the two kinds of vocabulary (fixed values).
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


class Remembered(dict):
    """A function's results, forgotten all at once when there are too many."""

    def __init__(self, function: Callable, limit: int = REMEMBERED):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(vocabulary: dict[str, int], end: str = "", mark: bytes = b"") -> dict[bytes, int]:
    """Byte strings of the vocabulary with their ids; ``mark`` stands for the suffix ``end``."""
    letters = byte_letters()
    ranks = {}
    for token, i in vocabulary.items():
        body = token.removesuffix(end) if end else token
        if all(c in letters for c in body):
            ranks.setdefault(
                bytes(letters[c] for c in body) + mark * (body != token), i
            )
    return ranks


class ByteCounter:
    """Counts tokens of a byte-level vocabulary."""

    def __init__(self, config: str, whole: frozenset[str]):
        self.tokenizer = Tokenizer.from_str(config)
        parsed = json.loads(config)
        self.special = re.compile(
            "|".join(re.escape(t["content"]) for t in parsed["added_tokens"]) or r"(?!)"
        )
        self.pattern = regex.compile(BYTE_PATTERN)
        self.merged = tiktoken.Encoding(
            "ranks",
            pat_str=BYTE_PATTERN,
            mergeable_ranks=ranks_of(parsed["model"]["vocab"]),
            special_tokens={},
        )
        self.whole = whole
        self.chunks = Remembered(self.count_chunk)

    def count_piece(self, piece: str) -> int:
        if not LATIN.fullmatch(piece):
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return sum(
            1 if t in self.whole else len(self.merged.encode_ordinary(t))
            for t in self.pattern.findall(piece)
        )

    def count_chunk(self, chunk: str) -> int:
        piece = " " + chunk
        return 1 if piece in self.whole else self.count_piece(piece)

    def count_plain(self, text: str) -> int:
        if LOOSE_SPACE.search(text):
            return self.count_piece(text)
        first, *rest = text.split(" ")
        return (self.count_piece(first) if first else 0) + sum(map(self.chunks.__getitem__, rest))

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.count_plain, parts))


class WordEncoder:
    """Ids of a vocabulary of lower-case words with a word-end suffix, as packed integers."""

    def __init__(self, config: str):
        self.tokenizer = Tokenizer.from_str(config)
        parsed = json.loads(config)
        vocabulary = parsed["model"]["vocab"]
        top = max([*vocabulary.values(), *(t["id"] for t in parsed["added_tokens"])])
        self.code = "H" if top < 1 << 16 else "I"
        self.special = re.compile(
            "|".join(re.escape(t["content"]) for t in parsed["added_tokens"]) or r"(?!)"
        )
        self.pattern = regex.compile(WORD_PATTERN)
        # a line feed never occurs in a pre-token, so it can mark the end of a word
        self.merged = tiktoken.Encoding(
            "ranks",
            pat_str=r"[^\n]+\n",
            mergeable_ranks=ranks_of(vocabulary, WORD_END, b"\n"),
            special_tokens={},
        )
        self.chunks = Remembered(self.encode_chunk)

    def encode_chunk(self, chunk: str) -> bytes:
        if not LATIN.fullmatch(chunk) or self.special.search(chunk):
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        else:
            words = self.pattern.findall(chunk.lower())
            ids = self.merged.encode_ordinary("\n".join(words) + "\n") if words else []
        return array(self.code, ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.split(" ")))


@lru_cache(maxsize=4)
def word_encoder(config: str) -> WordEncoder:
    return WordEncoder(config)


@lru_cache(maxsize=4)
def byte_counter(config: str, whole: frozenset[str]) -> ByteCounter:
    return ByteCounter(config, whole)


def whole_tokens(config: str) -> frozenset[str]:
    """The strings of the vocabulary that are one pre-token and encode alone as one token.

    Every candidate is encoded by the tokenizer itself. The set is bounded by the
    vocabulary, so it may travel to the executors.
    """
    tokenizer, pattern = Tokenizer.from_str(config), regex.compile(BYTE_PATTERN)
    special = {t["content"] for t in json.loads(config)["added_tokens"]}
    candidates = []
    for raw in ranks_of(json.loads(config)["model"]["vocab"]):
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if text not in special and LATIN.fullmatch(text) and pattern.fullmatch(text):
            candidates.append(text)
    encoded = tokenizer.encode_batch(candidates, add_special_tokens=False)
    return frozenset(t for t, e in zip(candidates, encoded, strict=True) if len(e.ids) == 1)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; ``vocabulary`` is a file path."""
    config = Path(vocabulary).read_text()
    shared = docs.sparkSession.sparkContext.broadcast((config, whole_tokens(config)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = byte_counter(*shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
