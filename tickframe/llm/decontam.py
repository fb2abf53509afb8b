"""Benchmark decontamination: pairs of words count what an alignment could reach, then Smith-Waterman.

Words are compared without case and ASCII punctuation. An alignment of an item of m words that reaches the threshold T has
k matching words and at most 2k - 2mT edits, so of its k - 1 pairs of successive matches at least mT - 1 have at most one
edit between them: two words of the item, next to each other or one apart, lie next to each other or one apart in the text.
The alignment covers at most (3 - 2T)m words of the text. A text is therefore aligned with an item wherever so many of the
item's pairs start within so many words, and no copy that reaches the threshold is lost, however common its words are; the
score is the local alignment's share of a full match.

The items are the query set: they are read in blocks of at most ``BLOCK_ITEMS`` rows and ``BLOCK_BYTES`` of text, and
only a block is sent to the workers. All texts are read whole against each block, as a map without a shuffle, so copies of
one passage in any number of texts stay where they are.

Null or wordless texts and items match nothing; an item of one or two words must be there whole. Repeated rows are judged each for
itself. An empty benchmark leaves every text clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import SPACE, Words, slices

#: Pairs of a text and an item's places that are looked at together, unless one text has more.
HITS = 1 << 21
#: Share of a full match from which a text counts as leaked.
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20

_BREAK = SPACE.copy()
_BREAK[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True

LEAKS = "array<struct<item_id:long,score:double,n_matches:int,first_word:int,end_word:int>>"


class Seeds:
    """The word pairs of a block of items: keys over the block's own vocabulary, and which items hold each."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = Words(pa.array(texts, pa.large_string()), lower=True, space=_BREAK)
        codes, self.vocabulary = words.encoded()
        self.ids = ids
        self.items = [codes[a:b] for a, b in zip(words.bounds, words.bounds[1:])]
        self.sizes = np.array([len(own) for own in self.items], np.int64)
        #: One spare code stands for the second word of an item of one word.
        self.base = len(self.vocabulary) + 1
        keys, item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, own in enumerate(self.items):
            if len(own):
                near = own[:-1] * self.base + own[1:] if len(own) > 1 else own * self.base + self.base - 1
                found = np.unique(np.concatenate((near, own[:-2] * self.base + own[2:])))
                keys.append(found), item.append(np.full(len(found), i))
        keys, item = np.concatenate(keys), np.concatenate(item)
        order = np.lexsort((item, keys))
        self.key, self.item = keys[order], item[order]
        self.distinct, self.first = np.unique(self.key, return_index=True)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, word, distinct pair and step between its words of every known pair in the texts; ``codes`` are the texts' words."""
        own, values = words.encoded()
        known = pc.fill_null(pc.index_in(values, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = known[own] if len(own) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
        at, keys, steps = [], [], []
        for step in range(3):
            n = max(0, len(codes) - step)
            whole = (of[:n] == of[step : step + n]) & (codes[:n] >= 0) & (codes[step : step + n] >= 0)
            place = np.flatnonzero(whole)
            at.append(place), steps.append(np.full(len(place), step))
            keys.append(codes[place] * self.base + (codes[place + step] if step else self.base - 1))
        at, keys, steps = np.concatenate(at), np.concatenate(keys), np.concatenate(steps)
        seed = np.searchsorted(self.distinct, keys)
        real = seed < len(self.distinct)
        real[real] = self.distinct[seed[real]] == keys[real]
        self.codes = codes
        return of[at[real]], at[real], seed[real], steps[real]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, matched words, first and end word in ``text``. Ties go to the earliest end.

    Rows are vectorised; a gap along the text is a running maximum. Score, then matches, then the later start decide.
    """
    n = len(text)
    # One number per cell: score, matches and start packed so that the maximum compares them in this order.
    unit_score, unit_match = 1 << 44, 1 << 24
    cols = np.arange(n + 1, dtype=np.int64)
    fresh = cols.copy()
    fresh_next = np.minimum(cols, n)
    above = fresh.copy()
    best = (0, 0, 0, 0)
    for word in item.tolist():
        gain = np.where(text == word, MATCH * unit_score + unit_match, MISMATCH * unit_score)
        row = fresh_next.copy()
        np.maximum(row[1:], above[:-1] + gain, out=row[1:])
        np.maximum(row, above + GAP * unit_score, out=row)
        row = np.maximum.accumulate(row - GAP * unit_score * cols) + GAP * unit_score * cols
        row = np.maximum(row, fresh_next)
        j = int(np.argmax(row >> 44))
        score = int(row[j] >> 44)
        if score > best[0]:
            rest = int(row[j] & (unit_score - 1))
            best = (score, rest >> 24, rest & (unit_match - 1), j)
        above = row
    return best


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    items = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n = max(1, -(-2 * size.n // BLOCK_ITEMS), -(-2 * size.b // BLOCK_BYTES))
    if n == 1:
        return [items]
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    return [dealt.where(F.col("block") == i).select("item_id", "text") for i in range(n)]


def _regions(first: np.ndarray, last: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Merged ranges of the text that hold every alignment over words ``first`` to ``last``."""
    cut = np.flatnonzero(first[1:] - reach > last[:-1] + reach) + 1
    for a, b in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(first)])).tolist()):
        yield int(first[a]) - reach, int(last[b - 1]) + reach


def _aligned(seeds: Seeds, words: Words, threshold: float) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(words.bounds) - 1)]
    rows, places, pairs, steps = seeds.hits(words)
    order = np.argsort(rows, kind="stable")
    rows, places, pairs, steps = rows[order], places[order], pairs[order], steps[order]
    sizes = (np.append(seeds.first[1:], len(seeds.key)) - seeds.first)[pairs] if len(pairs) else np.zeros(0, np.int64)
    need = np.maximum(1, np.ceil(seeds.sizes * threshold - 1 - 1e-9)).astype(np.int64)
    reach = (seeds.sizes * max(1.0, 3 - 2 * threshold)).astype(np.int64) + 2
    ahead, since = np.cumsum(sizes), 0
    while since < len(rows):
        # Whole rows, as many as have no more than HITS entries.
        until = int(np.searchsorted(ahead, (ahead[since - 1] if since else 0) + HITS, "right"))
        until = int(np.searchsorted(rows, rows[until], "left")) if until < len(rows) else until
        until = until if until > since else int(np.searchsorted(rows, rows[since], "right"))
        own = slice(since, until)
        since = until
        hit = np.repeat(np.arange(own.start, own.stop), sizes[own])
        within = np.arange(len(hit)) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
        item, row, word, step = seeds.item[seeds.first[pairs[hit]] + within], rows[hit], places[hit], steps[hit]
        # An item of one or two words counts where it lies whole.
        whole = (seeds.sizes[item] > 2) | (step == seeds.sizes[item] - 1)
        item, row, word = item[whole], row[whole], word[whole]
        order = np.lexsort((word, item, row))
        item, row, word = item[order], row[order], word[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (word[1:] != word[:-1])
        item, row, word = item[fresh], row[fresh], word[fresh]
        end = np.arange(len(row)) + need[item] - 1
        begin = np.flatnonzero(end < len(row))
        end = end[begin]
        close = (row[begin] == row[end]) & (item[begin] == item[end]) & (word[end] - word[begin] < reach[item[begin]])
        begin, end = begin[close], end[close]
        cut = np.flatnonzero((np.diff(row[begin]) != 0) | (np.diff(item[begin]) != 0)) + 1
        for some, last in zip(np.split(begin, cut), np.split(end, cut)):
            if len(some):
                _best(seeds, words, int(row[some[0]]), int(item[some[0]]), _regions(word[some], word[last], int(reach[item[some[0]]])), threshold, out)
    return out


def _best(seeds: Seeds, words: Words, r: int, i: int, regions: Iterator[tuple[int, int]], threshold: float, out: list[list[dict]]) -> None:
    """Add the best alignment of item ``i`` in the regions of text ``r``, if it reaches the threshold."""
    own, (low, high) = seeds.items[i], words.bounds[r : r + 2]
    best = None
    for x, y in regions:
        x, y = max(int(low), x), min(int(high), y)
        for z in range(x, y, 1 << 16):  # a long merged range goes in overlapping pieces
            found = align(own, seeds.codes[z : min(y, z + (1 << 16) + 3 * len(own))])
            if best is None or found[0] > best[0]:
                best = (*found[:2], found[2] + z - int(low), found[3] + z - int(low))
    share = best[0] / (MATCH * len(own)) if best else 0
    if share >= threshold:
        out[r].append({"item_id": seeds.ids[i], "score": share, "n_matches": best[1], "first_word": best[2], "end_word": best[3]})


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``leaks``: per test item that a text holds a copy of, the best alignment; empty for clean texts."""
    out = docs.select(*(c for c in docs.columns if c != "leaks")).withColumn("leaks", F.array().cast(LEAKS))
    schema = out.schema
    for block in _blocks(benchmark, item_id, "text"):
        rows = block.collect()
        seeds = Seeds([r.item_id for r in rows], [r.text for r in rows])

        def run(batches, seeds=seeds):
            for batch in slices(batches, text):
                found = _aligned(seeds, Words(batch.column(text), lower=True, space=_BREAK), threshold)
                if any(found):
                    at = batch.schema.get_field_index("leaks")
                    merged = [old + new for old, new in zip(batch.column(at).to_pylist(), found)]
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(merged, batch.schema.field(at).type))
                yield batch

        out = out.mapInArrow(run, schema)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per text and test item it holds a copy of."""
    found = with_leaks(docs.select(F.col(doc_id).alias("doc_id"), "text"), benchmark, **options)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
