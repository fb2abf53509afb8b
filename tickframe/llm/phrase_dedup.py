"""Exact substring dedup by prefix-free parsing.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the corpus. The parse cuts texts
into phrases by rolling hashes: over the first ``SPREAD`` positions of every ``LENGTH``-byte window, the least hash is
the window's trigger. A trigger depends on the window's bytes alone, so equal windows have equal triggers; consecutive
windows with the same trigger form a phrase, which reaches to the end of its last window. Phrases overlap by more than
what is compared, hence no comparison runs over a phrase's end: the order of windows in the corpus is the order of
suffixes in the dictionary of distinct phrases, and the parse itself only counts how often each phrase occurs.

1. Parse: per phrase a hash of the bytes that follow its trigger in each of its windows (the block), and one of the whole
   phrase. Only hashes and places leave the workers.
2. Dictionary: blocks, then phrases of the blocks that occur twice, are counted, combined before the shuffle. A phrase that
   occurs twice is repeated throughout; a block that occurs once holds no repeat.
3. Suffixes: what is left are blocks with several different phrases, mostly the rims of repeated passages. One copy of
   each distinct phrase is cut from the texts, the windows of a block are brought into order by digest, and equal
   neighbours are repeats. Blocks over ``HOT`` phrases send their windows through a shuffle instead of meeting in a task.
4. The repeated windows come together per document and their union is cut out.

Null texts count as empty. Rows that repeat id and text share one key: a text of ``LENGTH`` bytes or more in such rows
occurs more than once and goes from all of them. Keys are 64-bit digests of bytes (two texts of a key would have to
collide as well to be mistaken).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import buffers, document_keys, mixed, row_sums, settled, signed, slices

LENGTH, SPREAD = 200, 160
#: Bytes of the rolling hash.
_ROLL = 16
#: Bytes from the trigger on that every window of a phrase holds.
_BLOCK = LENGTH - SPREAD + 1
#: Bytes of a text that are parsed at once.
_PIECE = 1 << 20
#: Distinct phrases of a block whose windows a task compares.
HOT = 20_000


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every run of ``width`` elements, by doubling."""
    have, out = 1, keys
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def _triggers(data: np.ndarray) -> np.ndarray:
    """For each window of the piece, the position of its trigger: the first least rolling hash."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.zeros(len(data), np.uint64)
    for i in range(8):
        word |= padded[i : i + len(data)].astype(np.uint64) << np.uint64(8 * i)
    n = len(data) - _ROLL + 1
    rolled = word[:n] * np.uint64(0x9E3779B97F4A7C15) ^ (word[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7))
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    place = np.arange(n, dtype=np.uint64)
    keys = (rolled & np.uint64(0xFFFFFFFF00000000)) | place
    windows = len(data) - LENGTH + 1
    return (_least(keys, SPREAD)[:windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def phrases(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece: row, first window, windows, trigger (relative to the text) of each phrase."""
    for row in range(len(bounds) - 1):
        low, high = int(bounds[row]), int(bounds[row + 1])
        for at in range(low, high - LENGTH + 1, _PIECE):
            piece = data[at : min(high, at + _PIECE + LENGTH - 1)]
            found = _triggers(piece)
            cut = np.flatnonzero(np.diff(found)) + 1
            first = np.concatenate(([0], cut))
            count = np.diff(np.concatenate((first, [len(found)])))
            yield np.full(len(first), row), first + at - low, count, found[first] + at - low


def parse(keyed: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``first``, ``n``, ``at`` (offset of the trigger), ``block`` and ``phrase`` hashes of every phrase."""

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches):
            data, bounds = buffers(batch.column("text"))
            view, k1, k2 = memoryview(np.ascontiguousarray(data)), batch.column("k1"), batch.column("k2")
            held, rows = [], 0
            for part in phrases(data, bounds):
                held.append(part)
                rows += len(part[0])
            if not rows:
                continue
            row, first, n, at = (np.concatenate(x) for x in zip(*held))
            low = bounds[row]
            starts = (low + at).tolist()
            block = np.fromiter((digest(view[a : a + _BLOCK]) for a in starts), np.uint64, rows)
            spans = zip((low + first).tolist(), (low + first + n + LENGTH - 1).tolist())
            phrase = np.fromiter((digest(view[a:b]) for a, b in spans), np.uint64, rows)
            # Where the trigger lies is part of what a phrase is.
            phrase = mixed(phrase ^ mixed(at - first))
            yield pa.RecordBatch.from_arrays(
                [
                    k1.take(pa.array(row)),
                    k2.take(pa.array(row)),
                    pa.array(first.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array((at - first).astype(np.int32)),
                    pa.array(signed(block)),
                    pa.array(signed(phrase)),
                ],
                names=["k1", "k2", "first", "n", "at", "block", "phrase"],
            )

    return keyed.mapInArrow(run, "k1 long, k2 long, first int, n int, at int, block long, phrase long")


def _window_digests(text: bytes, n: int, at: int) -> list[int]:
    """A digest of each window of a phrase; windows with another place of the trigger never compare equal."""
    view, digest = memoryview(text), xxhash.xxh3_64_intdigest
    return [digest(view[i : i + LENGTH], at - i & 0xFFFF) for i in range(n)]


def _cut_phrases(batches):
    """The bytes of the wanted phrases of each text."""
    for batch in slices(batches):
        data, bounds = buffers(batch.column("text"))
        lists = batch.column("wanted")
        flat = lists.flatten()
        if not len(flat):
            continue
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        field = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
        n, first = field("n"), field("first")
        low = bounds[row] + first
        body = data.tobytes()
        texts = [body[a : a + k + LENGTH - 1] for a, k in zip(low.tolist(), n.tolist())]
        yield pa.RecordBatch.from_arrays(
            [*(flat.field(c) for c in ("block", "phrase", "n", "at", "hot")), pa.array(texts, pa.binary())],
            names=["block", "phrase", "n", "at", "hot", "body"],
        )


def _compare(batches):
    """Of runs of equal blocks (sorted input), the windows of phrases that other phrases of the block hold as well."""

    def closed(table):
        n, bodies, at = table["n"].to_pylist(), table["body"].to_pylist(), table["at"].to_pylist()
        blocks = table["block"].to_numpy()
        found = np.array([d for b, k, a in zip(bodies, n, at) for d in _window_digests(b, k, a)], np.uint64)
        owner = np.repeat(np.arange(len(n)), n)
        window = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        keys = mixed(found ^ mixed(blocks.view(np.uint64)[owner]))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        yield from _runs(table["block"], table["phrase"], owner, window, twice)

    rest, size = [], 0
    for batch in batches:
        if batch.num_rows:
            rest.append(batch)
            size += batch.num_rows
            if size >= 2000:
                table = pa.Table.from_batches(rest).combine_chunks()
                blocks = table["block"].to_numpy()
                cut = int(np.flatnonzero(blocks != blocks[-1])[-1]) + 1 if blocks[0] != blocks[-1] else 0
                if cut:
                    yield from closed(table.slice(0, cut))
                    rest = table.slice(cut).to_batches()
                    size = len(table) - cut
    if size:
        yield from closed(pa.Table.from_batches(rest).combine_chunks())


def _runs(blocks, phrases_, owner, window, twice):
    """Maximal runs of repeated windows of each phrase."""
    marked = np.flatnonzero(twice)
    if not len(marked):
        return
    opens = np.flatnonzero(np.concatenate(([True], (np.diff(marked) > 1) | (np.diff(owner[marked]) != 0))))
    lasts = np.append(opens[1:], len(marked)) - 1
    a, b = marked[opens], marked[lasts]
    own = pa.array(owner[a])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(blocks.take(own).to_numpy()),
            pa.array(phrases_.take(own).to_numpy()),
            pa.array(window[a].astype(np.int32)),
            pa.array((window[b] - window[a] + 1).astype(np.int32)),
        ],
        names=["block", "phrase", "skip", "many"],
    )


_RUNS = "block long, phrase long, skip int, many int"


def _hot_runs(hot: DataFrame) -> DataFrame:
    """The same for blocks with very many phrases: windows meet in a shuffle, counted before it."""

    def spread(batches):
        for batch in batches:
            for block, phrase, n, at, body in zip(*(batch.column(c).to_pylist() for c in ("block", "phrase", "n", "at", "body"))):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * n, pa.int64()),
                        pa.array([phrase] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array(signed(np.array(_window_digests(body, n, at), np.uint64))),
                    ],
                    names=["block", "phrase", "skip", "window"],
                )

    windows = hot.mapInArrow(spread, "block long, phrase long, skip int, window long")
    twice = windows.groupBy("block", "window").agg(F.count("*").alias("c")).where("c > 1").select("block", "window")
    return windows.join(twice, ["block", "window"]).select("block", "phrase", "skip", F.lit(1).alias("many"))


def repeated_windows(keyed: DataFrame, hot: int = HOT) -> DataFrame:
    """``k1``, ``k2``, ``first``, ``n``: runs of window starts whose ``LENGTH`` bytes also start elsewhere."""
    parsed = parse(keyed)
    blocks = parsed.groupBy("block").agg(F.count("*").alias("c")).where("c > 1").select("block")
    shared = settled(parsed.join(blocks, "block"), "phrases")
    dictionary = settled(shared.groupBy("block", "phrase").agg(F.count("*").alias("copies")), "dictionary")
    repeated = shared.join(dictionary.where("copies > 1"), ["block", "phrase"]).select("k1", "k2", "first", "n")

    rims = dictionary.groupBy("block").agg(F.count("*").alias("kinds")).where("kinds > 1")
    rims = settled(rims.select("block", (F.col("kinds") > hot).alias("hot")), "rims")
    distinct = shared.join(rims, "block").groupBy("block", "phrase").agg(*(F.first(c).alias(c) for c in ("k1", "k2", "first", "n", "at", "hot")))
    wanted = distinct.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("block", "phrase", "first", "n", "at", "hot")).alias("wanted")
    )
    cut = keyed.join(wanted, ["k1", "k2"]).mapInArrow(_cut_phrases, "block long, phrase long, n int, at int, hot boolean, body binary")
    if rims.where("hot").limit(1).count():
        cut = settled(cut, "suffixes")
        runs = cut.where("hot").transform(_hot_runs)
        cut = cut.where("not hot")
    else:
        runs = None
    cold = cut.drop("hot").repartition("block").sortWithinPartitions("block").mapInArrow(_compare, _RUNS)
    runs = cold if runs is None else cold.unionByName(runs)
    single = shared.join(dictionary.where("copies = 1"), ["block", "phrase"])
    partly = single.join(runs, ["block", "phrase"]).select("k1", "k2", (F.col("first") + F.col("skip")).alias("first"), F.col("many").alias("n"))
    return repeated.unionByName(partly)


_NEW = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"}


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that stay.

    What stays may end inside a character, hence bytes.
    """
    names = [c for c in docs.columns if c not in {*_NEW, text, "k1", "k2", "spans"}]
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(*names, *document_keys(doc_id, text), body.alias("_text"))
    spans = repeated_windows(keyed.select("k1", "k2", F.col("_text").alias("text")), hot)
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    joined = keyed.join(spans, ["k1", "k2"], "left").select(*names, "_text", "spans")
    schema = joined.select(*names).schema
    for name, kind in _NEW.items():
        schema = schema.add(name, kind)

    def run(batches):
        for batch in slices(batches, "_text"):
            data, bounds = buffers(batch.column("_text"))
            lists = batch.column("spans")
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            first, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n"))
            edges = np.zeros(len(data) + 1, np.int32)
            np.add.at(edges, bounds[row] + first, 1)
            np.add.at(edges, bounds[row] + first + n + LENGTH - 1, -1)
            gone = np.cumsum(edges[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            starts = bounds[:-1][bounds[:-1] < len(data)]
            opens[starts] |= gone[starts]
            ahead = np.concatenate(([0], np.cumsum(~gone)))
            kept = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ahead[bounds].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~gone]))]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(np.diff(bounds)),
                    pa.array(row_sums(gone, bounds)),
                    pa.array(row_sums(opens, bounds)),
                    kept.cast(pa.binary()),
                ],
                names=[*names, *_NEW],
            )

    return joined.mapInArrow(run, schema)
