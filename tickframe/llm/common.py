"""Helpers shared by the training-data operators: shared scratch tables, Arrow text buffers, words, document keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.session import scratch_root

#: Bytes of text that a Python worker handles at once, and rows of an Arrow batch of texts.
SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and executors share."""
    return scratch_root(spark)


def small_batches(spark: SparkSession) -> SparkSession:
    """Texts go to Python workers in batches of ``BATCH_ROWS`` rows at most: a worker and its executor hold little at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name, "10000"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there, lost executors cost nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def document_keys(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """``k1``, ``k2``: rows that repeat both id and text are one document and share one decision.

    A null id sorts before all others; a null text counts as empty.
    """
    key = F.col(doc_id).cast("long")
    return [
        F.coalesce(key, F.lit(-(1 << 63))).alias("k1"),
        F.xxhash64(F.coalesce(F.col(text), F.lit("")), key.isNull()).alias("k2"),
    ]


_REST = "_rest"


def packed_rest(docs: DataFrame, *own: str) -> DataFrame:
    """``own`` columns and all others as one struct, so that no name of theirs can clash with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias(_REST))


def unpacked_rest(rows: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """The columns of the table that ``packed_rest`` was given, in their order."""
    return rows.select(*(F.col(c) if c in own else F.col(f"{_REST}.`{c}`").alias(c) for c in columns))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its rows; nulls are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` bytes of text; a longer text comes alone and whole."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        first = 0
        while first < batch.num_rows:
            before = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a run of texts: ``codes`` into ``values``, ``bounds`` of each row's words."""

    def __init__(self, texts: pa.Array, lower: bool = False, space: np.ndarray = SPACE):
        data, offsets = buffers(texts)
        self.data, self.offsets = data, offsets
        inside = ~space[data]
        opens = inside.copy()
        if len(data):
            opens[1:] &= ~inside[:-1]
            firsts = offsets[:-1][offsets[:-1] < len(data)]
            opens[firsts] |= inside[firsts]
        starts = np.flatnonzero(opens)
        self.inside = inside
        compact = np.cumsum(inside)
        total = int(compact[-1]) if len(data) else 0
        self.word_offsets = np.append(compact[starts] - 1, total).astype(np.int64)
        body = data[inside]
        self.body = LOWER[body] if lower else body
        self.starts = starts
        self.bounds = np.searchsorted(starts, offsets)
        self._words: pa.Array | None = None

    def __len__(self) -> int:
        return len(self.word_offsets) - 1

    @property
    def words(self) -> pa.Array:
        if self._words is None:
            self._words = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(self), [None, pa.py_buffer(self.word_offsets), pa.py_buffer(np.ascontiguousarray(self.body))]
            )
        return self._words

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """Dense codes of the words and the distinct words."""
        made = self.words.dictionary_encode()
        return made.indices.to_numpy(zero_copy_only=False).astype(np.int64), made.dictionary


_NEWLINE = ord("\n")


def worded_lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each line (between line feeds) that holds a word."""
    data, offsets = words.data, words.offsets
    breaks = data == _NEWLINE
    at = np.flatnonzero(breaks)
    # The line that a feed opens belongs to the feed's text, even at the very end of it.
    starts = np.sort(np.concatenate((offsets[:-1], at + 1)), kind="stable")
    ends = np.sort(np.concatenate((offsets[1:], at)), kind="stable")
    of = np.repeat(np.arange(len(offsets) - 1), 1 + row_sums(breaks, offsets))
    filled = np.concatenate(([0], np.cumsum(words.inside)))
    worded = filled[ends] > filled[starts]
    return starts[worded], ends[worded], of[worded]


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a binary array."""
    lengths = ends - starts
    bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    take = np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[take]))]
    )


def digests(values: pa.Array) -> np.ndarray:
    """64-bit hashes of a binary array."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1].tolist()
    view, digest = memoryview(data) if data is not None else memoryview(b""), xxhash.xxh3_64_intdigest
    return np.fromiter((digest(view[a:b]) for a, b in zip(at, at[1:])), np.uint64, len(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def row_sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``bounds``."""
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[bounds])


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive codes."""
    n = max(0, len(codes) - width + 1)
    own, out = mixed(codes), np.zeros(n, np.uint64)
    for j in range(width):
        out = mixed(out ^ own[j : j + n])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: A key is heavy if it holds more than this part of the counted rows; so there are at most this many heavy keys.
HEAVY = 10_000


def salted_join(rows: DataFrame, keys: DataFrame, on: list[str], count: str, spread: Column, heavy: int = HEAVY) -> DataFrame:
    """``rows`` joined with the one row that ``keys`` (a settled table) has for each of theirs.

    ``count`` says how many rows a key has. Rows of heavy keys are salted by ``spread`` and the key's row is repeated, so that
    no task gets more than a ``heavy``-th part of the rows for one key. Only the heavy keys, ``heavy`` at most, are broadcast.
    """
    total = keys.agg(F.sum(count)).first()[0] or 0
    salts = F.ceil(F.col(count) / F.lit(max(1, -(-total // heavy)))).cast("int")
    salted = keys.withColumn("_salts", salts)
    crowded = F.broadcast(salted.where("_salts > 1").select(*on, "_salts"))
    left = rows.join(crowded, on, "left").withColumn("_salt", F.pmod(spread, F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    right = salted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"]).drop("_salt")
