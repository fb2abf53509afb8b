"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has 64 bits in a ring of eight segments. Two fingerprints with at most three differing bits have, by the
pigeonring principle, a segment from which every chain of l consecutive segments differs in at most l * 3/8 bits:
none in the first two segments, at most one up to the fifth, at most two up to the seventh. One differing bit lies in
one segment, so such a pair agrees in the first two and in two of the next three segments: 32 bits. Each
fingerprint therefore goes under 8 starts * 3 left-out segments = 24 keys of 32 bits; pairs that meet are pruned by the
chain budgets and then checked in full. No linked pair is lost, and unrelated pairs hardly meet.

Equal fingerprints are one vertex. Within a key the links are found by growing trees, so a group of near copies gives a
spanning forest rather than its pairs. A key with more than ``HOT`` fingerprints isn't compared in one task: there,
fingerprints that agree outside three bit positions link by definition, so they are grouped under every choice of three
of the positions that the key leaves free; rows grow with the group, not with its square, and spread over all tasks.

Null texts count as empty; texts without words have fingerprint zero and are linked like others. Every input row comes
back, repeated rows and null ids included; the component id is the least non-null ``doc_id``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Words, document_keys, packed_rest, settled, signed, slices, unpacked_rest
from tickframe.llm.components import components

BITS, SEGMENTS, DISTANCE = 64, 8, 3
_WIDTH = BITS // SEGMENTS
#: Fingerprints under one key that a task compares directly.
HOT = 4096
#: Shingle hashes whose bits are counted at once.
_BLOCK = 1 << 16


def _fingerprint(body: bytes, starts: list[int], ends: list[int], width: int) -> int:
    n = max(1, len(starts) - width + 1)
    lasts = ends[width - 1 :] if len(ends) >= width else ends[-1:]
    view, digest, ones = memoryview(body), xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for k in range(0, n, _BLOCK):
        h = np.array([digest(view[a:b], 42) for a, b in zip(starts[k : min(n, k + _BLOCK)], lasts[k : k + _BLOCK])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _spaced(words: Words) -> tuple[bytes, np.ndarray]:
    """All words joined by single spaces, and where each begins."""
    at = words.word_offsets
    n = len(words)
    out = np.full(int(at[-1]) + n, 0x20, np.uint8)
    of = np.repeat(np.arange(n), np.diff(at))
    out[np.arange(int(at[-1])) + of] = words.body
    return out.tobytes(), at[:-1] + np.arange(n)


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """``docs`` without the text, with ``fp`` (long): the majority bits of XXH64 over all word shingles of the whole text."""
    kept = [c for c in docs.columns if c not in (text, "fp")]
    schema = docs.select(*kept).schema.add("fp", "long")

    def run(batches):
        for batch in slices(batches, text):
            words = Words(batch.column(text), lower=True)
            body, starts = _spaced(words)
            ends = (starts + np.diff(words.word_offsets)).tolist()
            starts, bounds = starts.tolist(), words.bounds.tolist()
            found = np.array(
                [_fingerprint(body, starts[a:b], ends[a:b], width) if b > a else 0 for a, b in zip(bounds, bounds[1:])], np.uint64
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(signed(found))], names=[*kept, "fp"])

    return docs.select(*kept, text).mapInArrow(run, schema)


def _segment(i: int) -> int:
    return ((1 << _WIDTH) - 1) << (_WIDTH * (i % SEGMENTS))


def _chain(start: int, length: int) -> int:
    return sum(_segment(start + j) for j in range(length))


#: Per key kind: the bits that must agree, and the chain's start.
KINDS = [
    (sum(_segment(i + j) for j in range(5) if j != left_out), i) for i in range(SEGMENTS) for left_out in (2, 3, 4)
]
_BUDGETS = [[(_chain(i, n), n * DISTANCE // SEGMENTS) for n in (5, 7, SEGMENTS)] for i in range(SEGMENTS)]
_MASKS = np.array([m for m, _ in KINDS], np.uint64)


def _linked(one, other, start: int) -> np.ndarray:
    """Which pairs pass the chain budgets, shortest chain first, the last of which is the full Hamming check."""
    x = one ^ other
    alive = np.flatnonzero(np.bitwise_count(x & np.uint64(_BUDGETS[start][0][0])) <= _BUDGETS[start][0][1])
    for bits, budget in _BUDGETS[start][1:]:
        alive = alive[np.bitwise_count(x[alive] & np.uint64(bits)) <= budget]
    return alive


def _forest(values: np.ndarray, start: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``values``: trees grow a vertex at a time."""
    rest, out = values, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = _linked(rest, node, start)
            if len(near):
                grown = rest[near]
                out.extend((int(node), int(x)) for x in grown)
                queue.extend(grown)
                rest = np.delete(rest, near)
    return out


def _links(batches, hot: int):
    """Edges within runs of equal keys of sorted input; runs over ``hot`` come back as rows of kind ``hot``."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("hot", pa.int32())])

    def closed(kinds, keys, values):
        cut = np.flatnonzero((kinds[1:] != kinds[:-1]) | (keys[1:] != keys[:-1])) + 1
        firsts, lasts = np.concatenate(([0], cut)), np.concatenate((cut, [len(keys)]))
        sizes = lasts - firsts
        u, v, h = [], [], []
        pair = firsts[sizes == 2]
        for kind in np.unique(kinds[pair]).tolist():
            a = pair[kinds[pair] == kind]
            ok = _linked(values[a], values[a + 1], KINDS[kind][1])
            u.append(values[a][ok]), v.append(values[a + 1][ok]), h.append(np.full(len(ok), -1, np.int32))
        for first, last in zip(firsts[sizes > 2].tolist(), lasts[sizes > 2].tolist()):
            kind, run = int(kinds[first]), values[first:last]
            if last - first > hot:
                u.append(run), v.append(run), h.append(np.full(len(run), kind, np.int32))
                continue
            edges = np.array(_forest(run, KINDS[kind][1]), np.uint64).reshape(-1, 2)
            u.append(edges[:, 0]), v.append(edges[:, 1]), h.append(np.full(len(edges), -1, np.int32))
        if u:
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(u))), pa.array(signed(np.concatenate(v))), pa.array(np.concatenate(h))], schema=schema
            )

    open_ = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
    for batch in batches:
        new = [
            batch.column("kind").to_numpy(zero_copy_only=False),
            batch.column("key").to_numpy(zero_copy_only=False),
            batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64),
        ]
        kinds, keys, values = (np.concatenate(x) for x in zip(open_, new))
        if not len(keys):
            continue
        inner = np.flatnonzero((kinds != kinds[-1]) | (keys != keys[-1]))
        cut = int(inner[-1]) + 1 if len(inner) else 0
        if cut:
            yield from closed(kinds[:cut], keys[:cut], values[:cut])
        open_ = [kinds[cut:], keys[cut:], values[cut:]]
    if len(open_[1]):
        yield from closed(*open_)


def _hot_links(hot_rows: DataFrame) -> DataFrame:
    """Links of hot keys: under every choice of three free positions, fingerprints that agree elsewhere share a star."""

    def run(batches):
        for batch in batches:
            fps = batch.column("u").to_numpy(zero_copy_only=False).view(np.uint64)
            kinds = batch.column("hot").to_numpy(zero_copy_only=False)
            for kind in np.unique(kinds).tolist():
                own = fps[kinds == kind]
                free = [b for b in range(BITS) if not KINDS[kind][0] >> b & 1]
                for chosen in combinations(free, DISTANCE):
                    dropped = np.uint64(sum(1 << b for b in chosen))
                    kept = own & ~dropped
                    n = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(kept)), pa.array(np.full(n, dropped, np.uint64).view(np.int64)), pa.array(signed(own))],
                        names=["kept", "dropped", "fp"],
                    )

    # Without repeats: a fingerprint that is hot under several keys of a kind's free bits counts once for each.
    masked = hot_rows.select("u", "hot").distinct().mapInArrow(run, "kept long, dropped long, fp long")
    least = masked.groupBy("kept", "dropped").agg(F.min("fp").alias("u"), F.max("fp").alias("top")).where("u <> top")
    return masked.join(least, ["kept", "dropped"]).where("fp <> u").select("u", F.col("fp").alias("v")).distinct()


def links(vertices: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges ``u``, ``v`` that span every component of ``vertices`` (``fp`` long, distinct) under three differing bits."""
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(int(np.uint64(m).view(np.int64)))) for m in _MASKS))
    spread = vertices.select("fp", F.posexplode(keys).alias("kind", "key"))
    sorted_ = spread.repartition("kind", "key").sortWithinPartitions("kind", "key")
    found = settled(
        sorted_.select("kind", "key", "fp").mapInArrow(lambda it: _links(it, hot), "u long, v long, hot int"), "links"
    )
    return found.where("hot < 0").select("u", "v").unionByName(_hot_links(found.where("hot >= 0")))


def _labelled(prints: DataFrame, hot: int) -> DataFrame:
    """``fp``, ``rep`` (least id that has it) and ``label`` (one of the fingerprints of its component)."""
    vertices = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    labels = components(links(vertices.select("fp"), hot)).select(F.col("vertex").alias("fp"), "label")
    return vertices.join(labels, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "rep")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, hot: int = HOT) -> DataFrame:
    """Every row's ``doc_id``, ``fp`` and ``component_id``."""
    prints = settled(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), width=width), "prints")
    reps = _labelled(prints, hot)
    least = reps.groupBy("label").agg(F.min("rep").alias("component_id"))
    return prints.join(reps.select("fp", "label").join(least, "label"), "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, hot: int = HOT) -> DataFrame:
    """One row of each group of near duplicates: that of the least ``k1``, ``k2`` (see ``document_keys``), whole.

    A group without any id keeps one row too. Rows that repeat id and text count as one document; of them one stays.
    """
    keyed = packed_rest(docs, doc_id, text).select("*", *document_keys(doc_id, text))
    prints = settled(
        fingerprints(keyed.select("k1", "k2", F.col(text).alias("text")), width=width).withColumnRenamed("k1", "doc_id"), "prints"
    )
    reps = _labelled(prints, hot)
    per_print = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "k2")).alias("least"))
    firsts = (
        per_print.join(reps.select("fp", "label"), "fp")
        .groupBy("label")
        .agg(F.min("least").alias("least"))
        .select(F.col("least.doc_id").alias("k1"), F.col("least.k2").alias("k2"))
    )
    copies = prints.groupBy(F.col("doc_id").alias("k1"), "k2").agg(F.count("*").alias("n_copies"))
    kept = keyed.join(firsts.join(copies, ["k1", "k2"]), ["k1", "k2"])
    once = kept.where("n_copies = 1")
    rows = once.unionByName(kept.where("n_copies > 1").dropDuplicates(["k1", "k2"]))
    return unpacked_rest(rows, docs.columns, doc_id, text)
