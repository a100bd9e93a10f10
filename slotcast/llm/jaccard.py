"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes. It is cut into
fragments, which cuts every document's n-gram set into segments:

* Candidates. Two sets with similarity at or above the threshold differ in at most k
  n-grams, and k follows from their sizes. With k + 2 fragments, at least two segments of
  such a pair are identical. Each set emits a signature of every segment (empty segments
  only where two or more of its own are empty, which keeps the argument), so every pair
  that qualifies shares a signature. Sizes fall into classes, since both sides must be
  cut alike; a set small enough to have its partner in the class below is cut twice.
* Verification. Candidates first compare sketches, one bit per place for the parity of
  the n-grams that fall there. Two sketches differ in no more places than their sets do in
  n-grams, so a pair whose sketches differ too much is ruled out without fetching its sets.
  For the rest the order is cut anew into a fixed number of fragments. Per pair the overlap
  is counted in each fragment separately, and the partial counts are summed.

Documents with equal sets form one node first, so copies are never compared. Links are
sought for components, not for their own sake: a pair inside a known component is not
tested. Round 0 tests each node against one other that shares a signature with it, the one
that shares the largest part of its signatures, which is nearest to what a group was copied
from. What then still spans several components is compared whole: a signature's members are
dealt to bounded blocks, every pair of blocks in one task, and only pairs whose sketches
allow a link leave the task to be verified. A first round lets out each member's nearest three
partners, which joins most of a group; the signatures that had more are compared again with
their new components, at last without any bound. No candidate is capped, and a group of near
copies costs a few tests per copy.

Defined cases: null and blank texts have an empty set, link with nothing and are their
own component; a text with fewer words than ``words`` has one n-gram, its whole sequence.
Null document ids take part; a component's id is the least id that is not null.
Two different sets are taken as equal if their 64-bit hashes collide, and two n-grams if 52
bits of theirs do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.llm.common import join_small, staged, stored
from slotcast.llm.components import connected_components
from slotcast.llm.tokens import Remembered
from slotcast.session import job_stages

#: Fragments of the verification.
FRAGMENTS = 16
#: Members of a signature that meet in one task.
BLOCK = 2048
#: Partners of a member that one round verifies; the last round leaves none out.
KEEPS = (3, 64, None)
#: Entries of a comparison matrix, and pairs whose sketches are compared, at a time.
MATRIX, PAIRS = 1 << 20, 1 << 14
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def ngram_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text, in lower case for A-Z."""
    tokens = (text or "").encode().lower().split()
    ids = np.fromiter(map(word_hashes().__getitem__, tokens), dtype=U64, count=len(tokens))
    n = min(words, len(ids))
    if not n:
        return ids
    total = np.full(len(ids) - n + 1, n, dtype=U64)
    for i in range(n):
        total = mixed(total + ids[i : len(ids) - n + 1 + i])
    return np.unique(total)


class SizeClasses:
    """Classes of set sizes for a threshold of ``percent`` of 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.starts = [1]

    def start(self, c: int) -> int:
        """Least size of class c. A partner is at most one class away."""
        while len(self.starts) <= c:
            low = self.starts[-1]
            for _ in range(2):
                low = -(-low * 100 // self.percent)
            self.starts.append(max(low, self.starts[-1] + 1))
        return self.starts[c]

    def of(self, size: int) -> int:
        c = 0
        while self.start(c + 1) <= size:
            c += 1
        return c

    def fragments(self, c: int) -> int:
        """Fragments for pairs whose smaller set is in class c; 0 if such sets must be equal."""
        most = (self.start(c + 1) - 1) * (100 - self.percent) // self.percent
        return most + 2 if most else 0

    def cuts(self, size: int) -> list[tuple[int, int]]:
        """(class, fragments) of each way a set of this size is cut."""
        c = self.of(size)
        out = [(c, self.fragments(c))]
        if c and self.percent * size <= 100 * (self.start(c) - 1):
            out.append((c - 1, self.fragments(c - 1)))
        return [x for x in out if x[1]]


def segment_signatures(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """One signature for every segment that a partner must be able to share."""
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(grams ^ U64(0x5DEECE66D)))])
    out = [np.zeros(0, U64)]
    for c, m in classes.cuts(len(grams)):
        place = ((grams >> U64(32)) * U64(m)) >> U64(32)
        edges = np.searchsorted(place, np.arange(m + 1, dtype=U64))
        filled = edges[1:] > edges[:-1]
        which = np.arange(m)
        if m - filled.sum() < 2:
            which = which[filled]
        segment = sums[edges[1:]] - sums[edges[:-1]]
        tag = U64((c + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        out.append(mixed(mixed(segment[which] + tag) + which.astype(U64)))
    return np.concatenate(out)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def node_of(grams: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(grams.tobytes())], U64)


def document_sets(docs: DataFrame, words: int, keys: Sequence[str] = ()) -> DataFrame:
    """(doc_id, *keys, n_shingles, node, odd) of every row.

    ``node`` stands for the set and ``odd`` is its sketch; both are null if it is empty.
    ``keys`` are columns of long integers that go along.
    """
    names = ["doc_id", *keys, "n_shingles", "node"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            sets = [ngram_set(t, words) for t in texts.to_pylist()]
            nodes = [int(node_of(s).view(np.int64)[0]) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array([odd_sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                [*names, "odd"],
            )

    return docs.select(F.col("doc_id").cast("long"), *keys, "text").mapInArrow(
        build, ", ".join([*(f"`{name}` long" for name in names), "odd binary"])
    )


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(sig, node) of all sets; a batch sends the signatures of copies once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            seen: set[int] = set()
            sigs, nodes = [np.zeros(0, U64)], [np.zeros(0, U64)]
            for text in batch.column(0).to_pylist():
                grams = ngram_set(text, words)
                node = node_of(grams)
                if len(grams) and int(node[0]) not in seen:
                    seen.add(int(node[0]))
                    sigs.append(segment_signatures(grams, classes))
                    nodes.append(np.repeat(node, len(sigs[-1])))
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate(sigs)), _signed(np.concatenate(nodes))], ["sig", "node"]
            )

    return docs.select("text").mapInArrow(build, "sig long, node long")


def odd_sketch(grams: np.ndarray) -> np.ndarray:
    """One bit per place for whether an odd number of n-grams falls there, as words of 64.

    There are between one and two places per n-gram, 64 at least.
    The sketches of two sets differ in no more places than the sets differ in n-grams.
    """
    places = max(64, 1 << (len(grams) - 1).bit_length())
    counts = np.bincount((grams & U64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8)).view(U64)


def halved(sketch: np.ndarray, width: int) -> np.ndarray:
    """The sketch on ``width`` words: a place is odd if an odd number of those it stands for is."""
    while len(sketch) > width:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def fewest_differences(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the n-grams that only one of two sets holds, from their sketches."""
    width = min(len(a), len(b))
    return int(np.bitwise_count(halved(a, width) ^ halved(b, width)).sum())


def fragments_of(docs: DataFrame, words: int) -> DataFrame:
    """(node, grams): each set's segments, six bytes of hash per n-gram; copies once a batch."""

    def segments(grams: np.ndarray) -> list[bytes]:
        low = grams.view(np.uint8).reshape(-1, 8)[:, :6]
        edges = np.searchsorted(grams >> U64(60), np.arange(FRAGMENTS + 1, dtype=U64))
        return [low[edges[f] : edges[f + 1]].tobytes() for f in range(FRAGMENTS)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {}
            for text in batch.column(0).to_pylist():
                grams = ngram_set(text, words)
                node = int(node_of(grams).view(np.int64)[0])
                if len(grams) and node not in rows:
                    rows[node] = segments(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.list_(pa.binary()))],
                ["node", "grams"],
            )

    return docs.select("text").mapInArrow(build, "node long, grams array<binary>")


def single_nodes(found: DataFrame, wanted: int) -> DataFrame:
    """``found`` with one row per node; ids on several rows bring sets more than once."""
    if found.count() <= wanted:
        return found
    return staged(found.groupBy("node").agg(F.first("grams").alias("grams")), "single-sets")


def six_bytes(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(U64).ravel()


@F.arrow_udf(T.ArrayType(T.LongType()))
def partial_overlaps(a: pa.Array, b: pa.Array) -> pa.Array:
    """Common six-byte values of two sets, fragment by fragment."""

    def common(x: bytes, y: bytes) -> int:
        if x == y:
            return len(x) // 6
        return len(np.intersect1d(six_bytes(x), six_bytes(y), assume_unique=True))

    return pa.array(
        [[common(x, y) for x, y in zip(p, q, strict=True)] for p, q in zip(a.to_pylist(), b.to_pylist(), strict=True)],
        pa.list_(pa.int64()),
    )


@F.arrow_udf(T.LongType())
def least_difference(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(
        [
            fewest_differences(np.frombuffer(x, U64), np.frombuffer(y, U64))
            for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)
        ],
        pa.int64(),
    )


def linked(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity is at least ``percent`` of 100.

    Pairs whose sizes or sketches already differ too much are left out, and only the sets
    of the rest are made again from their texts. With union u and common n-grams c, u - c
    of them are in one set only, and 100 * c >= percent * u means
    (100 + percent) * (u - c) <= (100 - percent) * (na + nb).
    """
    ends = [
        sizes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("odd").alias(f"o{x}"))
        for x in ("a", "b")
    ]
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    near = (100 + percent) * least_difference("oa", "ob") <= (100 - percent) * (F.col("na") + F.col("nb"))
    fitting = staged(
        pairs.join(ends[0], "a").join(ends[1], "b").where(alike).where(near).select("a", "b", "na", "nb"),
        "fitting-pairs",
    )
    nodes = fitting.select(F.col("a").alias("node")).union(fitting.select("b")).distinct()
    wanted = staged(sizes.select("node", "doc_id").join(nodes, "node", "left_semi"), "fitting-nodes")
    fetched = staged(
        fragments_of(join_small(docs, wanted.select("doc_id"), ["doc_id"], "left_semi"), words),
        "fitting-sets",
    )
    sets = single_nodes(fetched, wanted.count())
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    part = fitting.join(left, "a").join(right, "b").withColumn("parts", partial_overlaps("ga", "gb"))
    both = F.aggregate("parts", F.lit(0).cast("long"), lambda x, y: x + y)
    whole = part.select("a", "b", "na", "nb", both.alias("both"))
    return whole.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def open_signatures(shared: DataFrame, near: DataFrame, links: DataFrame) -> DataFrame:
    """(sig, node, comp, members) of the signatures in ``shared`` that span components."""
    labels = staged(
        near.select("node").join(connected_components(links), "node", "left").select(
            "node", F.coalesce("component", "node").alias("comp")
        ),
        "labels",
    )
    placed = shared.select("sig", "node").join(labels, "node")
    spans = placed.groupBy("sig").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members")
    ).where("lo <> hi")
    return staged(placed.join(spans.select("sig", "members"), "sig"), "open-signatures")


def survivors(table: pa.Table, percent: int, keep: int | None) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of pairs of a block that differ in component and may link, by size and sketch.

    Each member gives the ``keep`` partners whose sketches are nearest; the last value says
    whether there were more.
    """
    comp, n, side = (table[c].to_numpy() for c in ("comp", "n", "side"))
    odd = [np.frombuffer(x, U64) for x in table["odd"].to_pylist()]
    width = np.array([len(x) for x in odd])
    both_sides = bool(side.any())
    first, second, more = [], [], False
    for w in np.unique(width):
        at = np.flatnonzero(width >= w)
        folded = np.stack([halved(odd[i], w) for i in at])
        wider, place = width[at] > w, np.arange(len(at))
        mine = np.flatnonzero(~wider)
        step = max(1, MATRIX // len(at))
        for rows in (mine[i : i + step] for i in range(0, len(mine), step)):
            me, them = at[rows][:, None], at[None, :]
            # pairs of one width are met once, in their order; others from the narrower side
            ok = (wider[None, :] | (place[None, :] > rows[:, None])) & (comp[me] != comp[them])
            ok &= 100 * np.minimum(n[me], n[them]) >= percent * np.maximum(n[me], n[them])
            if both_sides:
                ok &= side[me] != side[them]
            i, j = np.nonzero(ok)
            fewest = np.concatenate(
                [np.zeros(0, np.int64)]
                + [
                    np.bitwise_count(folded[rows[i[k : k + PAIRS]]] ^ folded[j[k : k + PAIRS]]).sum(axis=1)
                    for k in range(0, len(i), PAIRS)
                ]
            )
            i, j = rows[i], j
            fits = (100 + percent) * fewest <= (100 - percent) * (n[at[i]] + n[at[j]])
            i, j, fewest = i[fits], j[fits], fewest[fits]
            if keep is not None and len(i):
                order = np.lexsort((j, fewest, i))
                i, j = i[order], j[order]
                starts = np.flatnonzero(np.diff(i, prepend=-1))
                rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
                more = more or bool((rank >= keep).any())
                i, j = i[rank < keep], j[rank < keep]
            first.append(at[i])
            second.append(at[j])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *first]), np.concatenate([empty, *second]), more


def block_pairs(members: DataFrame, percent: int, keep: int | None = None, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of a signature that may link, from (sig, node, comp, members, n, odd).

    A signature's members are dealt to blocks by hash, and every pair of blocks is compared
    in one task. Only what survives leaves it, and of that only the nearest ``keep`` of each
    member; a row (null, null, sig) names a signature that has more. Pairs may repeat.
    """
    dealt = members.withColumn("blocks", F.ceil(F.col("members") / (block * 0.8)).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "sig",
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node", "comp", "n", "odd",
    )
    names = met.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(table: pa.Table) -> pa.RecordBatch:
            node = table["node"].to_numpy()
            i, j, more = survivors(table, percent, keep)
            a, b = (pa.array(end(node[i], node[j])) for end in (np.minimum, np.maximum))
            sig = pa.nulls(len(a), pa.int64())
            if more:
                a, b = (pa.concat_arrays([x, pa.nulls(1, pa.int64())]) for x in (a, b))
                sig = pa.concat_arrays([sig, pa.array([table["sig"][0].as_py()], pa.int64())])
            return pa.RecordBatch.from_arrays([a, b, sig], ["a", "b", "sig"])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch.rename_columns(names)])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = np.stack([table[c].to_numpy() for c in ("sig", "lo", "hi")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist()]
            for a, b in zip(edges, edges[1:]):
                yield pairs(table.slice(a, b - a))
            rest = table.slice(edges[-1])  # its group may go on in the next batch
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    placed = met.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi")
    return placed.mapInArrow(work, "a long, b long, sig long")


def jaccard_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, keys: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, *keys, n_shingles, comp) of every row of ``docs``.

    Rows that links reach share ``comp``, whatever their ids; it is null for empty sets.
    Two documents link when 100 * intersection >= percent * union.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    with job_stages(docs.sparkSession):  # only the result stays
        sets = staged(document_sets(docs, words, keys), "sets")
        by_sig = W.partitionBy("sig")
        shared = staged(
            signatures(docs, words, percent)
            .select("sig", "node", F.min("node").over(by_sig).alias("lo"),
                    F.max("node").over(by_sig).alias("hi"))
            .where("lo <> hi")
            .select("sig", "node"),
            "shared-signatures",
        )
        # a set that shares many of its signatures is close to what its group was copied from
        near = staged(shared.groupBy("node").agg(F.count("*").alias("sigs")), "near-nodes")
        samples = staged(
            join_small(sets.where("node is not null"), near.select("node"), ["node"], "left_semi")
            .groupBy("node")
            .agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"), F.first("odd").alias("odd")),
            "near-samples",
        )
        texts = docs.select("doc_id", "text")
        sizes = staged(
            samples.join(near, "node").select(
                "node", "n", "doc_id", "odd", (-F.col("sigs") / F.col("n")).alias("apart")
            ),
            "near-sizes",
        )
        # signatures of the same sets ask the same question; one of them stays
        groups = shared.groupBy("sig").agg(
            F.count("*").alias("members"),
            F.bit_xor(F.xxhash64("node")).alias("one"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
        )
        asked = groups.groupBy("members", "one", "two").agg(F.min("sig").alias("sig"))
        shared = staged(shared.join(asked.select("sig"), "sig").select("sig", "node"), "distinct-signatures")
        ranks = sizes.select("node", "apart")
        lead = F.min(F.struct("apart", "node")).over(by_sig)
        stars = (
            shared.join(ranks, "node").withColumn("lead", lead)
            .groupBy("node").agg(F.min("lead").alias("lead")).where("node <> lead.node")
        )
        tested = staged(
            stars.select(*ordered(F.col("lead.node"), F.col("node"))).distinct(), "tested"
        )
        links = staged(linked(tested, sizes, texts, words, percent), "links")
        for keep in KEEPS:
            shared = open_signatures(shared, near, links)
            if shared.isEmpty():
                break
            found = staged(block_pairs(shared.join(sizes.select("node", "n", "odd"), "node"), percent, keep), "found")
            pairs = staged(
                found.where("a is not null").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"),
                "pairs",
            )
            tested = staged(tested.union(pairs), "tested")
            links = staged(links.union(linked(pairs, sizes, texts, words, percent)), "links")
            shared = shared.join(found.where("a is null").select("sig").distinct(), "sig", "left_semi")
        roots = connected_components(links)
        groups = sets.join(roots, "node", "left").select(
            "doc_id", *keys, "n_shingles", F.coalesce("component", "node").alias("comp")
        )
        return stored(groups, "jaccard-groups")[0]


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    The component is the least document id that links reach.
    """
    rooted = jaccard_groups(docs, words, percent)
    lowest = rooted.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("low"))
    return rooted.join(lowest, "comp", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id")
    )
