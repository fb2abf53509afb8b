"""Repeated runs of lines, by prefix doubling over line-ID sequences.

A text is the sequence of its lines that hold a word. As in the doubling construction of a suffix array, round r names
every run of 2**r lines by the names of its halves; only names that occur twice stay, so a round works on
repeated runs alone. What goes are the later copies of maximal repeated runs (intervals of the suffix array whose longest
common prefix reaches ``min_words`` words), to their last line. Such a run is the union of the shortest runs of
``min_words`` words inside it, taken both from each line on and up to each line: a line with enough words behind it lies in the
shortest run from it, any other in the shortest run up to the end. So those runs are what is compared; from a line there
are at most ``min_words`` of them. The round whose power of two is next below a run's length names it by its two
overlapping ends.

Of all occurrences of a run the first by (``doc_id``, line) stays, the lines of the later ones go. Rounds are tables in
the shared folder. Counts are combined before the shuffle; names that many lines have are salted before they meet their
count, and so are runs that many texts hold.

Null texts stay null, texts without words stay as they are, blank lines go only inside a deleted run. Rows that repeat id
and text are one document: the second such row is no copy of the first, use exact dedup for those. Null ids sort first.
Other columns are kept as they are whatever their names; one that has the name of a new column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Words, cut_out, digests, document_keys, salted_join, settled, signed, slices, worded_lines

MIN_WORDS = 50

_AT = ["k1", "k2", "pos"]


def _shortest_runs(words: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First line and length of the shortest runs of ``least`` words from each line on and up to each line.

    ``words`` are the words per line, ``bounds`` the lines of each text.
    """
    lines = np.arange(len(words))
    upto = np.concatenate(([0], np.cumsum(words)))
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    last = np.searchsorted(upto, upto[:-1] + least)
    onwards = last <= bounds[of + 1]
    first = np.searchsorted(upto, upto[1:] - least, "right") - 1
    back = (upto[1:] >= least) & (first >= bounds[of])
    starts = np.concatenate((lines[onwards], first[back]))
    spans = np.concatenate((last[onwards] - lines[onwards], lines[back] - first[back] + 1))
    both = np.unique(np.stack((starts, spans), axis=1), axis=0)
    return both[:, 0], both[:, 1]


def line_ids(docs: DataFrame, min_words: int, text: str = "text") -> DataFrame:
    """``k1``, ``k2``, ``pos``, ``name`` of each line with a word, and ``spans``: lines of the runs from it that are compared."""

    def run(batches):
        for batch in slices(batches, text):
            words = Words(batch.column(text))
            starts, ends, of = worded_lines(words)
            codes = cut_out(words.data, starts, ends).dictionary_encode()
            names = digests(codes.dictionary)[codes.indices.to_numpy(zero_copy_only=False)] if len(starts) else np.zeros(0, np.uint64)
            n_words = np.diff(np.append(np.searchsorted(words.starts, starts), len(words)))
            bounds = np.searchsorted(of, np.arange(batch.num_rows + 1))
            lead, span = _shortest_runs(n_words, bounds, min_words)
            offsets = np.searchsorted(lead, np.arange(len(starts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1").take(pa.array(of)),
                    batch.column("k2").take(pa.array(of)),
                    pa.array((np.arange(len(starts)) - bounds[of]).astype(np.int32)),
                    pa.array(signed(names)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(span.astype(np.int32))),
                ],
                names=[*_AT, "name", "spans"],
            )

    rows = docs.select(*document_keys(text=text), text)
    return rows.mapInArrow(run, "k1 long, k2 long, pos int, name long, spans array<int>")


def _repeated(named: DataFrame) -> DataFrame:
    twice = settled(named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"), "names")
    return salted_join(named, twice, ["name"], "n", F.xxhash64(*_AT)).select(*_AT, "name", "spans")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """``k1``, ``k2``, ``pos``, ``span`` of runs that repeat an earlier one."""
    level = settled(_repeated(settled(line_ids(docs, min_words, text), "lines")), "runs")
    width, found = 1, []
    while True:
        ends = level.select("k1", "k2", (F.col("pos")).alias("end"), F.col("name").alias("tail"))
        # Column functions call their lambdas at once, so they see this round's width.
        due = F.filter("spans", lambda n: (n >= width) & (n < 2 * width))
        found.append(
            level.select(*_AT, "name", F.explode(due).alias("span"))
            .withColumn("end", F.col("pos") + F.col("span") - width)
            .join(ends, ["k1", "k2", "end"])
            .select(*_AT, "span", F.xxhash64("span", "name", "tail").alias("run"))
        )
        longer = F.exists("spans", lambda n: n >= 2 * width)
        if not level.where(longer).limit(1).count():
            break
        pairs = (
            level.withColumn("end", F.col("pos") + width)
            .join(ends, ["k1", "k2", "end"])
            .select(*_AT, F.xxhash64("name", "tail").alias("name"), "spans")
        )
        level, width = settled(_repeated(pairs), "runs"), 2 * width
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionByName(more)
    runs = settled(runs, "runs")
    firsts = settled(runs.groupBy("run").agg(F.min(F.struct(*_AT)).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    later = salted_join(runs, firsts, ["run"], "n", F.xxhash64(*_AT))
    return later.where(F.struct(*_AT) > F.col("first")).select(*_AT, "span")


_NEW = {"n_lines": "long", "n_removed_lines": "long", "n_runs": "long"}


def _cut(words: Words, gone: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Per row the bytes kept; and lines, removed lines, removed runs."""
    starts, ends, of = worded_lines(words)
    data, offsets = words.data, words.offsets
    firsts = np.searchsorted(of, np.arange(len(offsets)))
    texts, counts = [], np.zeros((len(gone), 3), np.int64)
    for r, runs in enumerate(gone):
        first, n = firsts[r], firsts[r + 1] - firsts[r]
        counts[r, 0] = n
        whole = data[offsets[r] : offsets[r + 1]]
        if not runs:
            texts.append(whole)
            continue
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, [x["pos"] for x in runs], 1)
        np.add.at(edges, [x["pos"] + x["span"] for x in runs], -1)
        dead = np.cumsum(edges[:-1]) > 0
        opens = np.flatnonzero(np.diff(np.concatenate(([False], dead, [False])).astype(np.int8)))
        keep = np.ones(len(whole), bool)
        for a, b in opens.reshape(-1, 2).tolist():
            # From the start of the first line to the start of the next kept one, or the text's end with the feed before.
            stop = starts[first + b] - offsets[r] if b < n else len(whole)
            keep[starts[first + a] - offsets[r] - (b == n and a > 0) : stop] = False
        counts[r, 1:] = dead.sum(), len(opens) // 2
        texts.append(whole[keep])
    return texts, counts


def without_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """``docs`` with later copies of line runs cut from ``text``, and ``n_lines``, ``n_removed_lines``, ``n_runs``."""
    names = [c for c in docs.columns if c not in _NEW]
    others = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in names if c != text)).alias("_row")
    keyed = docs.select(others, F.col(text).alias("_text"), *document_keys(text=text))
    gone = later_copies(docs, min_words, text).groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "span")).alias("gone"))
    joined = keyed.join(gone, ["k1", "k2"], "left").select("_row", "_text", "gone")
    schema = joined.select("_row", "_text").schema
    for name, kind in _NEW.items():
        schema = schema.add(name, kind)

    def run(batches):
        for batch in slices(batches, "_text"):
            old = batch.column("_text")
            texts, counts = _cut(Words(old), batch.column("gone").to_pylist())
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
            body = np.ascontiguousarray(np.concatenate(texts)) if texts else np.zeros(0, np.uint8)
            valid = None if not old.null_count else pa.py_buffer(np.packbits(old.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
            new = pa.LargeStringArray.from_buffers(len(old), pa.py_buffer(bounds), pa.py_buffer(body), valid).cast(old.type)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), new, *(pa.array(counts[:, i]) for i in range(3))], names=["_row", "_text", *_NEW]
            )

    cut = joined.mapInArrow(run, schema)
    return cut.select(*(F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in names), *_NEW)
