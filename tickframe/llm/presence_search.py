"""Ranked lexical search by presence masks.

Items (the query set) are taken in blocks of ``BLOCK_TERMS`` terms, so what a task is sent is bounded; per block:

1. One pass over the whole texts writes each document's length and its counts of the block's terms, compared as bytes.
   Documents, lengths and document frequencies are aggregates of that table.
2. A second pass reads that table only. Tasks gather ``BLOCK_DOCS`` documents at a time; per item, each term's documents set
   a bit, which gives a mask of matched terms per document. Documents are grouped by mask. The greatest count of each
   term and the least length norm of the block bound the score of a mask; masks are evaluated by descending bound until
   the bound is under the last score that still ranks. That score is carried from block to block of a task.
3. What tasks keep (``top`` rows an item) is ranked in two steps, first within hash buckets of documents, then by item.

Nothing is cut off: a mask is passed over only if none of its documents can rank, and equal bounds are evaluated, since
ties go to the lesser ``doc_id``. Null texts have no terms; they, texts without terms and items without terms match
nothing. Null ids rank after all others of their score. Repeated rows of ``docs`` are documents of their own; items that
repeat id and text are one item, items that share an id only are ranked apart under that id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tickframe.llm.common import Words, settled, slices, small_batches

TOP = 20
#: Distinct terms of the items that are searched in one go; an item with more comes alone.
BLOCK_TERMS = 100_000
#: Documents, and counts of terms, whose masks a task holds at once.
BLOCK_DOCS, BLOCK_COUNTS = 1 << 15, 1 << 22
#: Hash buckets of the first ranking.
SPREAD = 32
_LAST = np.iinfo(np.int64).max

#: Bytes between terms: all of ASCII but digits and letters.
BREAK = np.zeros(256, dtype=bool)
BREAK[:0x80] = True
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    BREAK[ord(_low) : ord(_high) + 1] = False


def terms(texts: pa.Array) -> Words:
    """Terms of a run of texts, A-Z lower-cased."""
    return Words(texts, lower=True, space=BREAK)


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item``, ``words`` and ``counts`` of each item that has terms."""

    def run(batches):
        for batch in slices(batches):
            found = terms(batch.column("text"))
            words, bounds = found.words.to_pylist(), found.bounds.tolist()
            counts = [Counter(words[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item"),
                    pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                ],
                names=["item", "words", "counts"],
            )

    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).distinct()
    schema = rows.select("item").schema.add("words", ArrayType(BinaryType())).add("counts", ArrayType(LongType()))
    return rows.mapInArrow(run, schema).where(F.size("words") > 0)


def _blocks(rows: DataFrame, limit: int) -> Iterator[list]:
    """Items in blocks of about ``limit`` distinct terms; the driver holds one block and one partition of items."""
    block, held = [], set()
    for row in rows.toLocalIterator():
        if block and len(held) + len(row.words) > limit:
            yield block
            block, held = [], set()
        block.append(row)
        held.update(map(bytes, row.words))
    if block:
        yield block


def _counts(docs: DataFrame, vocabulary: list[bytes], doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n`` (terms of the document), ``terms`` and ``tfs`` (places in the vocabulary and counts) of documents with terms."""

    def run(batches):
        wanted = pa.array(vocabulary, pa.large_binary())
        for batch in slices(batches):
            found = terms(batch.column("text"))
            n = np.diff(found.bounds)
            codes, distinct = found.encoded()
            place = pc.fill_null(pc.index_in(distinct, value_set=wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            own = place[codes] if len(codes) else codes
            hit = np.flatnonzero(own >= 0)
            row = np.repeat(np.arange(len(n)), n)[hit]
            keys, tfs = np.unique(row * len(vocabulary) + own[hit], return_counts=True)
            some = np.flatnonzero(n)
            bounds = np.searchsorted(keys // len(vocabulary), np.append(some, len(n)))
            offsets = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(some)),
                    pa.array(n[some]),
                    pa.ListArray.from_arrays(offsets, pa.array((keys % len(vocabulary)).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int64))),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class _Ranked:
    """The ``top`` best documents of an item so far: highest score, then known before null id, then least id."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.unknown = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A score below this can't rank."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        fit = scores >= self.least()
        scores, ids, unknown = (np.concatenate(p) for p in ((self.scores, scores[fit]), (self.ids, ids[fit]), (self.unknown, unknown[fit])))
        order = np.lexsort((ids, unknown, -scores))[: self.top]
        self.scores, self.ids, self.unknown = scores[order], ids[order], unknown[order]


class _Postings:
    """The counts of a run of documents, by term."""

    def __init__(self, batches: list[pa.RecordBatch], n_docs: int, n_terms: int, width: int):
        column = lambda name: pa.chunked_array([b.column(name) for b in batches])
        ids = column("doc_id")
        self.unknown = ids.is_null().to_numpy()
        self.ids = ids.fill_null(_LAST).to_numpy()
        # The length norm of a document, from its share of all terms.
        self.norms = 75 + 25 * column("n").to_numpy() * n_docs // n_terms
        sizes = pc.list_value_length(column("terms")).to_numpy()
        of = np.repeat(np.arange(len(sizes)), sizes)
        term = pc.list_flatten(column("terms")).to_numpy()
        order = np.argsort(term, kind="stable")
        self.docs, self.tfs = of[order], pc.list_flatten(column("tfs")).to_numpy()[order]
        self.bounds = np.searchsorted(term[order], np.arange(width + 1))
        held = np.flatnonzero(np.diff(self.bounds))
        most = np.zeros(width, np.int64)
        if len(held):
            most[held] = np.maximum.reduceat(self.tfs, self.bounds[held])
        #: No document of the run gets more from a term of weight one.
        self.most = self.part(most, self.norms.min(initial=_LAST // 12))

    @staticmethod
    def part(tf: np.ndarray, norm: np.ndarray | int) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 12 * norm)

    def scores(self, own: np.ndarray, weights: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Whole scores of the ``chosen`` documents (ascending)."""
        out, norms = np.zeros(len(chosen), np.int64), self.norms[chosen]
        for t, w in zip(own.tolist(), weights.tolist()):
            docs = self.docs[self.bounds[t] : self.bounds[t + 1]]
            at = np.searchsorted(docs, chosen)
            hit = np.flatnonzero(docs[np.minimum(at, len(docs) - 1)] == chosen)
            out[hit] += w * self.part(self.tfs[self.bounds[t] + at[hit]], norms[hit])
        return out


def _masks(postings: _Postings, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with a term of ``own``, the group of equal masks of each, and the bits (group x term) of each group."""
    words = np.zeros(((len(own) + 63) // 64, len(postings.ids)), np.uint64)
    for j, t in enumerate(own.tolist()):
        words[j // 64, postings.docs[postings.bounds[t] : postings.bounds[t + 1]]] |= np.uint64(1 << j % 64)
    docs = np.flatnonzero(np.bitwise_or.reduce(words, axis=0))
    words = words[:, docs]
    _, first, group = np.unique(words[0], return_index=True, return_inverse=True)
    for word in words[1:]:
        _, code = np.unique(word, return_inverse=True)
        _, first, group = np.unique(group * (len(code) + 1) + code, return_index=True, return_inverse=True)
    bits = np.unpackbits(np.ascontiguousarray(words[:, first].T).view(np.uint8), axis=1, bitorder="little", count=len(own))
    return docs, group, bits


def _search(postings: _Postings, own: np.ndarray, weights: np.ndarray, ranked: _Ranked) -> None:
    """Rank the documents of the run, masks by descending bound until no further one can rank."""
    bounds = weights * postings.most[own]
    some = np.flatnonzero(bounds)
    own, weights, bounds = own[some], weights[some], bounds[some]
    if not len(own) or int(bounds.sum()) < ranked.least():
        return
    docs, group, bits = _masks(postings, own)
    limit = bits.astype(np.int64) @ bounds
    order = np.argsort(-limit, kind="stable")
    limit = limit[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by_mask = np.argsort(place[group], kind="stable")
    ends = np.cumsum(np.bincount(place[group], minlength=len(order)))
    done, many = 0, 4 * ranked.top
    while done < len(order) and limit[done] >= ranked.least():
        start = int(ends[done - 1]) if done else 0
        able = int(np.searchsorted(-limit, -ranked.least(), "right"))
        last = min(able, max(done + 1, int(np.searchsorted(ends, start + many, "right"))))
        chosen = np.sort(docs[by_mask[start : int(ends[last - 1])]])
        ranked.add(postings.scores(own, weights, chosen), postings.ids[chosen], postings.unknown[chosen])
        done, many = last, 2 * many


def _search_block(counts: DataFrame, block: list, vocabulary: list[bytes], top: int) -> DataFrame:
    """``_place`` (of the item in the block), ``doc_id`` and ``score`` of what each task ranks."""
    totals = counts.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_terms = totals.n, totals.l or 1
    found = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in found:
        weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    place = {w: i for i, w in enumerate(vocabulary)}
    queries = []
    for row in block:
        own = np.array([place[bytes(w)] for w in row.words])
        queries.append((own, weight[own] * np.array(row.counts, np.int64)))
    block_docs, block_counts = BLOCK_DOCS, BLOCK_COUNTS

    def run(batches):
        ranked = [_Ranked(top) for _ in queries]

        def closed(held):
            postings = _Postings(held, n_docs, n_terms, len(vocabulary))
            for (own, weights), best in zip(queries, ranked):
                _search(postings, own, weights, best)

        held, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            size += len(batch.column("terms").flatten())
            if rows >= block_docs or size >= block_counts:
                closed(held)
                held, rows, size = [], 0, 0
        if held:
            closed(held)
        for i, best in enumerate(ranked):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best.ids), i, np.int32)), pa.array(best.ids, mask=best.unknown), pa.array(best.scores)],
                names=["_place", "doc_id", "score"],
            )

    return counts.mapInArrow(run, "_place int, doc_id long, score long")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """``rank`` of the ``top`` best rows of each item, first within buckets of documents."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    spread = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SPREAD)))
    first = spread.withColumn("rank", F.row_number().over(Window.partitionBy("_place", "_part").orderBy(*order))).where(F.col("rank") <= top)
    return first.drop("_part").withColumn("rank", F.row_number().over(Window.partitionBy("_place").orderBy(*order))).where(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``top`` documents of every item."""
    spark = small_batches(docs.sparkSession)
    found = []
    for block in _blocks(_item_terms(items, item_id, text), block_terms):
        vocabulary = sorted({bytes(w) for row in block for w in row.words})
        counts = settled(_counts(docs, vocabulary, doc_id, text), "counts")
        best = settled(_ranked(_search_block(counts, block, vocabulary, top), top), "ranked")
        names = spark.createDataFrame([(i, row["item"]) for i, row in enumerate(block)], _names(items, item_id))
        # One row per item of the block, at most block_terms of them.
        found.append(best.join(F.broadcast(names), "_place").select(item_id, "rank", "doc_id", "score"))
    if not found:
        empty = items.select(item_id).limit(0)
        return empty.select(item_id, F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return reduce(DataFrame.unionByName, found)


def _names(items: DataFrame, item_id: str) -> StructType:
    return StructType([StructField("_place", IntegerType()), StructField(item_id, items.schema[item_id].dataType)])
