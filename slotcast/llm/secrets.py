"""Secret scans: fixed patterns and sliding-window entropy over candidate strings.

Three patterns are always reported. Beyond them, every run of characters of a class that
is long enough is a candidate, and a window slides over it one character at a time. The
Shannon entropy of the window is kept by incremental counts: one character leaves, one
enters, and only their terms of the sum change. Windows at or above the threshold of their
class merge into spans. Windows that overlap an allow-list match give no span; the rest of
their candidate is scanned all the same.

Spans are (kind, start, end) in code points, end exclusive, by start and then by kind in
the order of ``KINDS``. A span of a pattern is its whole match; entropy spans may overlap
them.

Defined cases: a null or empty text has no spans, or stays as it is when redacted. Texts
are scanned whole. Rows are independent, so repeated rows, nulls elsewhere and extra
columns play no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The patterns are fixed values; the numbers are the least lengths of a match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_LENGTH = 12
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Whatever the other patterns and the classes below match lies in such a run.
LONG_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one alphabet; ``kinds`` are patterns of which each window needs one."""

    name: str
    run: re.Pattern
    window: int
    bits: float
    kinds: tuple[re.Pattern, ...]


CLASSES = (
    CharacterClass(
        "entropy_hex",
        re.compile(r"[0-9A-Fa-f]{16,}"),
        16,
        2.8,
        (re.compile("[0-9]"), re.compile("[A-Fa-f]")),
    ),
    CharacterClass(
        "entropy_base64",
        re.compile(r"[A-Za-z0-9+/_=-]{20,}"),
        20,
        3.7,
        (re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")),
    ),
    CharacterClass(
        "entropy_lower",
        re.compile(r"[a-z0-9]{20,}"),
        20,
        3.5,
        (re.compile("[0-9]"), re.compile("[a-z]")),
    ),
    CharacterClass(
        "entropy_upper",
        re.compile(r"[A-Z0-9]{20,}"),
        20,
        3.5,
        (re.compile("[0-9]"), re.compile("[A-Z]")),
    ),
)
KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))
BASE_KINDS = KINDS[:3]
#: Candidates that are no secrets: identifiers, running alphabets, placeholders.
ALLOWED = (
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
    r"(?i)(?:0123456789abcdef|abcdefghijklmnop|1234567890)",
    r"(?i)example|placeholder|changeme|your[_-]|x{6,}|0{8,}",
)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def entropy_windows(text: str, window: int) -> Iterator[tuple[int, float]]:
    """(start, bits) of every window of a candidate, from counts kept incrementally."""
    counts: dict[str, int] = {}
    term = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    total = 0.0
    for i, new in enumerate(text):
        if i >= window:
            old = text[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += term[c - 1] - term[c]
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += term[c + 1] - term[c]
        if i >= window - 1:
            yield i - window + 1, math.log2(window) - total / window


def allowed_stretches(text: str, allowed: Sequence[re.Pattern]) -> list[tuple[int, int]]:
    """(start, end) of what the allow-list matches, in order, overlapping matches as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(m.span() for a in allowed for m in a.finditer(text)):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        elif start < end:
            out.append((start, end))
    return out


def entropy_spans(
    text: str, offset: int, chars: CharacterClass, allowed: Sequence[re.Pattern] = ()
) -> Iterator[Span]:
    """Merged windows at or above the threshold that mix all kinds and overlap nothing allowed."""
    start = end = -1
    free, at = allowed_stretches(text, allowed), 0
    for i, bits in entropy_windows(text, chars.window):
        stop = i + chars.window
        while at < len(free) and free[at][1] <= i:
            at += 1
        if at < len(free) and free[at][0] < stop:
            continue
        if bits < chars.bits or not all(k.search(text, i, stop) for k in chars.kinds):
            continue
        if i > end >= 0:
            yield Span(chars.name, offset + start, offset + end)
        if i > end:
            start = i
        end = stop
    if end >= 0:
        yield Span(chars.name, offset + start, offset + end)


def spans_of(text: str | None, allowed: Sequence[re.Pattern] = ()) -> list[Span]:
    """All spans of a text in order."""
    if not text:
        return []
    spans = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        spans += [
            Span("assign", *m.span())
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= ASSIGN_LENGTH
        ]
    for run in LONG_RUN.finditer(text):
        at, stop = run.span()
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            spans += [Span(kind, *m.span()) for m in pattern.finditer(text, at, stop)]
        for chars in CLASSES:
            for m in chars.run.finditer(text, at, stop):
                spans += entropy_spans(m[0], m.start(), chars, allowed)
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redacted(text: str | None, spans: Sequence[Span], mark: str) -> str | None:
    """The text with every maximal stretch of overlapping spans replaced by ``mark``."""
    if not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s.end <= at:
            continue
        if s.start >= at:
            out += [text[at : s.start], mark]
        at = s.end
    return "".join([*out, text[at:]])


SPAN_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def find_secrets(
    docs: DataFrame, allowed: Sequence[str] = ALLOWED, column: str = "spans"
) -> DataFrame:
    """``docs`` with its spans as ``array<struct<kind, start, end>>`` in ``column``."""
    patterns = [re.compile(a) for a in allowed]

    @F.arrow_udf(T.ArrayType(SPAN_TYPE))
    def find(texts: pa.Array) -> pa.Array:
        return pa.array(
            [[s._asdict() for s in spans_of(t, patterns)] for t in texts.to_pylist()],
            ARROW_SPANS,
        )

    return docs.withColumn(column, find("text"))


def redact_secrets(
    docs: DataFrame, allowed: Sequence[str] = ALLOWED, mark: str = "[secret]"
) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``."""
    patterns = [re.compile(a) for a in allowed]

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        return pa.array(
            [redacted(t, spans_of(t, patterns), mark) for t in texts.to_pylist()], pa.string()
        )

    return docs.withColumn("text", redact("text"))
