"""Substring dedup over words by compressed FM-indexes, one per shard.

A word goes if a window of ``LENGTH`` words that covers it also starts earlier: in a document of lesser key, or earlier in
the same one. To search every document against every index would grow with the square of the corpus, so texts are dealt
to shards by content first:

1. Pieces: over the first ``SPREAD`` positions of a window, the block of ``BLOCK`` words with the least hash is its
   anchor; consecutive windows with one anchor form a piece. Equal windows have equal anchors, so all copies of a window
   lie in pieces of one block. Blocks are counted, combined before the shuffle; one that occurs once holds no repeat.
2. Equal pieces (by 128 bits) are counted with their first place, combined before the shuffle. All but the first copy
   are repeated throughout.
3. Shards: where a block has several different pieces, the first copy of each is cut from the texts and streamed to a
   shard, which holds whole blocks of about ``SHARD_WORDS`` words. The shard's pieces are indexed: suffixes in order up
   to the longest piece, their Burrows-Wheeler transform in a wavelet matrix of packed bits with counted words. Backward
   search takes all pieces through the index together, a word to the left at a time, and gives the matching statistics
   of each end, up to ``LENGTH``. Ends that reach it come with their suffix interval, whose least place tells
   whether the window starts earlier. Words are compared by content there.
4. The repeated windows come together per document and their union is cut out.

Blocks over ``HOT`` different pieces would not fit a shard; of them each window is a piece of its own, and step 2
decides. Blocks and pieces that hold many rows are salted before they are joined.

Null texts count as empty, a null id sorts before all others. Rows that repeat id and text are one document: none of them
counts as earlier than another, and all lose the same words. Rows that share an id only are ordered by a hash of the
text. Other columns are kept; one that has the name of a new column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Words, digests, document_keys, mixed, packed_rest, row_sums, salted_join, settled, signed, slices, unpacked_rest, window_hashes

LENGTH, BLOCK = 20, 10
SPREAD = LENGTH - BLOCK + 1
#: Words whose windows are parsed at once.
_PIECE = 1 << 18
#: Words of a shard, but for its last block.
SHARD_WORDS = 1 << 17
#: Different pieces of a block that come into one shard.
HOT = 5000
_KEY = ["block", "p1", "p2"]


def _anchors(blocks: np.ndarray) -> np.ndarray:
    """For each run of ``SPREAD`` block hashes, the place of its first least one."""
    keys = (blocks & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(blocks), dtype=np.uint64)
    have, out = 1, keys
    while 2 * have <= SPREAD:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < SPREAD:
        out = np.minimum(out[: len(out) - (SPREAD - have)], out[SPREAD - have :])
    return (out & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Spans:
    """64-bit digests of runs of hashes, by prefix sums of a polynomial modulo 2^64 with an odd base."""

    def __init__(self, hashes: np.ndarray, base: int):
        n = len(hashes) + 1
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(base, n)[:-1], dtype=np.uint64)))
        self.back = _powers(pow(base, -1, 1 << 64), n)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _word_hashes(words: Words) -> np.ndarray:
    codes, distinct = words.encoded()
    return mixed(digests(distinct))[codes] if len(codes) else np.zeros(0, np.uint64)


def _pieces(hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """First window (by place in ``hashes``), windows, place of the anchor, block and both digests of each piece."""
    for at in range(0, len(hashes) - LENGTH + 1, _PIECE):
        part = hashes[at : at + _PIECE + LENGTH - 1]
        blocks = window_hashes(part, BLOCK)
        found = _anchors(blocks)
        place = np.arange(len(found)) + at
        end = bounds[np.searchsorted(bounds, place, "right")]
        inside = np.flatnonzero(place + LENGTH <= end)
        if not len(inside):
            continue
        anchor = found[inside]
        opens = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(inside) > 1))))
        first, anchor = inside[opens], anchor[opens]
        n = np.diff(np.append(opens, len(inside)))
        # Where the anchor lies is part of what a piece is.
        salt = mixed((anchor - first).astype(np.uint64))
        p1, p2 = (_Spans(part, base)(first, first + n + LENGTH - 1) ^ salt for base in _BASES)
        yield first + at, n, anchor + at, blocks[anchor], p1, p2


def parse(keyed: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``first`` (word), ``n`` (windows), ``block``, ``p1`` and ``p2`` of every piece."""

    def run(batches):
        for batch in slices(batches):
            words = Words(batch.column("text"))
            for first, n, _, block, p1, p2 in _pieces(_word_hashes(words), words.bounds):
                row = np.searchsorted(words.bounds, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("k1").take(pa.array(row)),
                        batch.column("k2").take(pa.array(row)),
                        pa.array((first - words.bounds[row]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        *(pa.array(signed(x)) for x in (block, p1, p2)),
                    ],
                    names=["k1", "k2", "first", "n", *_KEY],
                )

    return keyed.mapInArrow(run, "k1 long, k2 long, first int, n int, block long, p1 long, p2 long")


class WaveletMatrix:
    """Ranks of symbols over a sequence: a row of packed bits per binary digit, highest first, with counts per 64 bits."""

    def __init__(self, values: np.ndarray, n_symbols: int):
        self.size = len(values)
        self.digits = list(range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1))
        self.words, self.ones, self.zeros = [], [], []
        for digit in self.digits:
            bits = (values >> digit & 1).astype(bool)
            packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
            row = np.packbits(bits, bitorder="little")
            packed[: len(row)] = row
            packed = packed.view(np.uint64)
            self.words.append(packed)
            self.ones.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)[:-1])).astype(np.int32))
            self.zeros.append(len(bits) - int(bits.sum()))
            values = np.concatenate((values[~bits], values[bits]))

    def descend(self, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Where the prefix before ``at`` ends among the equal symbols of the last row: differences are ranks."""
        for digit, words, ones, zeros in zip(self.digits, self.words, self.ones, self.zeros):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            rank = ones[word] + np.bitwise_count(words[word] & below)
            at = np.where(symbols >> digit & 1, zeros + rank, at - rank)
        return at


class FmIndex:
    """Backward search over a text of symbols (0 between pieces); suffixes are in order by their first ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        rank, have = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while have < depth:
            ahead = np.concatenate((rank[have:] + 1, np.zeros(min(have, len(rank)), np.int64)))[: len(rank)]
            keys = rank * (len(text) + 2) + ahead
            order = np.argsort(keys, kind="stable")
            step = np.concatenate(([0], np.cumsum(np.diff(keys[order]) != 0)))
            rank = np.empty_like(rank)
            rank[order] = step
            have *= 2
        #: Places in the text, in the order of their suffixes.
        self.places = order
        n_symbols = int(text.max(initial=0)) + 1
        self.size = len(text)
        self.waves = WaveletMatrix(text[order - 1], n_symbols)
        starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))[:-1]))
        every = np.arange(n_symbols)
        self.base = starts - self.waves.descend(np.zeros(n_symbols, np.int64), every)

    def extend(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the matches with one more symbol to their left."""
        both = self.waves.descend(np.concatenate((low, high)), np.concatenate((symbols, symbols)))
        base = self.base[symbols]
        return base + both[: len(low)], base + both[len(low) :]

    def matches(self, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Matching statistics of each end, up to ``length``: how many symbols before it occur elsewhere as well.

        With them, the ends that reach ``length`` and their suffix intervals.
        """
        reached = np.zeros(len(ends), np.int32)
        alive = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for k in range(length):
            low, high = self.extend(low, high, text[ends[alive] - 1 - k])
            twice = high - low > 1
            alive, low, high = alive[twice], low[twice], high[twice]
            reached[alive] = k + 1
        return reached, alive, low, high


def _earlier(index: FmIndex, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``places`` (by place in the text) over each suffix interval; intervals are equal or apart."""
    ordered = places[index.places]
    starts, of = np.unique(low, return_inverse=True)
    ends = np.empty_like(starts)
    ends[of] = high
    edges = np.append(np.stack((starts, ends), axis=1).ravel(), len(ordered))
    least = np.minimum.reduceat(np.append(ordered, ordered[:1]), edges[:-1])[::2] if len(starts) else starts
    return least[of]


def _shard(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Runs of windows of the shard's pieces that start earlier in another piece."""
    words = Words(table["body"].combine_chunks())
    codes, _ = words.encoded()
    sizes = np.diff(words.bounds)
    of = np.repeat(np.arange(len(sizes)), sizes + 1)
    text = np.zeros(len(of), np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    offset = np.arange(len(of)) - starts[of]
    text[offset < sizes[of]] = codes + 1
    index = FmIndex(text, int(sizes.max()))

    ends = np.flatnonzero((offset >= LENGTH) & (offset <= sizes[of]))
    _, alive, low, high = index.matches(text, ends, LENGTH)
    if not len(alive):
        return
    k1, k2, first = (table[c].to_numpy() for c in ("k1", "k2", "first"))
    order = np.lexsort((k2, k1))
    doc = np.empty(len(order), np.int64)
    doc[order] = np.concatenate(([0], np.cumsum((np.diff(k1[order]) != 0) | (np.diff(k2[order]) != 0))))
    places = (doc[of] << 32) + first[of] + offset
    begins = ends[alive] - LENGTH
    later = begins[_earlier(index, places, low, high) < places[begins]]
    if not len(later):
        return
    later = np.sort(later)
    opens = np.flatnonzero(np.concatenate(([True], np.diff(later) > 1)))
    lead = later[opens]
    piece = of[lead]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(k1[piece]),
            pa.array(k2[piece]),
            pa.array((first[piece] + offset[lead]).astype(np.int32)),
            pa.array(np.diff(np.append(opens, len(later))).astype(np.int32)),
        ],
        names=["k1", "k2", "first", "n"],
    )


_SPANS = "k1 long, k2 long, first int, n int"


def _search_shards(batches, limit: int) -> Iterator[pa.RecordBatch]:
    """Shards of whole blocks of sorted input."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(batch.column("n").to_numpy().sum()) + LENGTH * batch.num_rows
        if size >= limit:
            table = pa.Table.from_batches(held)
            blocks = table["block"].to_numpy()
            cut = int(np.flatnonzero(blocks != blocks[-1])[-1]) + 1 if blocks[0] != blocks[-1] else 0
            if cut:
                yield from _shard(table.slice(0, cut))
                table = table.slice(cut)
            held = table.combine_chunks().to_batches()
            size = int(table["n"].to_numpy().sum()) + LENGTH * len(table)
    if held:
        yield from _shard(pa.Table.from_batches(held))


def _cut(batches) -> Iterator[pa.RecordBatch]:
    """The text of the wanted pieces of each document, from their first word to their last."""
    for batch in slices(batches):
        lists = batch.column("wanted")
        flat = lists.flatten()
        if not len(flat):
            continue
        words = Words(batch.column("text"))
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        first, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n"))
        lead = words.bounds[row] + first
        last = lead + n + LENGTH - 2
        body = words.data.tobytes()
        ends = words.starts[last] + np.diff(words.word_offsets)[last]
        texts = [body[a:b] for a, b in zip(words.starts[lead].tolist(), ends.tolist())]
        own = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("k1").take(own),
                batch.column("k2").take(own),
                *(flat.field(c) for c in ("first", "n", "block", "hot")),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            names=["k1", "k2", "first", "n", "block", "hot", "body"],
        )


def _single_windows(batches) -> Iterator[pa.RecordBatch]:
    """Each window of a piece as a piece of its own."""
    for batch in slices(batches, "body"):
        words = Words(batch.column("body"))
        hashes = _word_hashes(words)
        n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(n)), n)
        skip = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        lead = words.bounds[row] + skip
        own = pa.array(row)
        first = batch.column("first").to_numpy(zero_copy_only=False)[row] + skip
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("k1").take(own),
                batch.column("k2").take(own),
                pa.array(first.astype(np.int32)),
                *(pa.array(signed(_Spans(hashes, base)(lead, lead + LENGTH))) for base in _BASES),
            ],
            names=["k1", "k2", "first", "p1", "p2"],
        )


def _later_copies(rows: DataFrame, counted: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` but for the first of each key; ``counted`` has ``copies`` and the first place of each key."""
    joined = salted_join(rows, counted.where("copies > 1").select(*key, "copies", "least"), key, "copies", F.xxhash64("k1", "k2", "first"))
    return joined.where(F.struct("k1", "k2", "first") != F.col("least"))


def _counted(rows: DataFrame, key: list[str], *more) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("copies"), F.min(F.struct("k1", "k2", "first")).alias("least"), *more)


def earlier_windows(keyed: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``k1``, ``k2``, ``first``, ``n``: runs of window starts whose ``LENGTH`` words also start earlier."""
    place = F.xxhash64("k1", "k2", "first")
    blocks = settled(parse(keyed).groupBy("block").agg(F.count("*").alias("rows")).where("rows > 1"), "blocks")
    shared = settled(salted_join(parse(keyed), blocks, ["block"], "rows", place).drop("rows"), "pieces")
    distinct = settled(_counted(shared, _KEY, F.max("n").alias("n")), "distinct")
    copies = _later_copies(shared, distinct, _KEY).select("k1", "k2", "first", "n")

    rims = settled(distinct.groupBy("block").agg(F.count("*").alias("kinds")).where("kinds > 1"), "rims")
    wanted = salted_join(distinct, rims, ["block"], "kinds", F.xxhash64("p1", "p2"))
    wanted = wanted.select("least.k1", "least.k2", F.struct("least.first", "n", "block", (F.col("kinds") > hot).alias("hot")).alias("piece"))
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_list("piece").alias("wanted"))
    cut = keyed.join(wanted, ["k1", "k2"]).mapInArrow(_cut, _SPANS + ", block long, hot boolean, body string")
    if not rims.where(F.col("kinds") > hot).limit(1).count():
        crowded = None
    else:
        cut = settled(cut, "cut")
        windows = settled(cut.where("hot").mapInArrow(_single_windows, "k1 long, k2 long, first int, p1 long, p2 long").distinct(), "windows")
        crowded = _later_copies(windows, settled(_counted(windows, ["p1", "p2"]), "counted"), ["p1", "p2"])
        crowded = crowded.select("k1", "k2", "first", F.lit(1).alias("n"))
        cut = cut.where("not hot")
    found = cut.drop("hot").repartition("block").sortWithinPartitions("block").mapInArrow(lambda it: _search_shards(it, shard_words), _SPANS)
    found = found.unionByName(copies)
    return found if crowded is None else found.unionByName(crowded)


_NEW = {"n_words": "long", "n_removed": "long"}


def _apply(batches, rest: list[str]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that the spans cover."""
    for batch in slices(batches):
        words = Words(batch.column("text"))
        lists = batch.column("spans")
        flat = lists.flatten()
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        first, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n"))
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, words.bounds[row] + first, 1)
        np.add.at(edges, words.bounds[row] + first + n + LENGTH - 1, -1)
        kept = np.cumsum(edges[:-1]) == 0
        ahead = np.concatenate(([0], np.cumsum(kept)))
        # A blank before each kept word but the first of its text.
        sizes = np.diff(words.word_offsets)[kept]
        before = np.ones(len(sizes), bool)
        leads = ahead[words.bounds[:-1]]
        before[leads[leads < ahead[words.bounds[1:]]]] = False
        ends = np.concatenate(([0], np.cumsum(sizes + before)))
        out = np.full(int(ends[-1]), 0x20, np.uint8)
        source = np.repeat(words.word_offsets[:-1][kept] - (ends[:-1] + before), sizes)
        target = np.repeat(ends[:-1] + before - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum()))
        out[target] = words.body[target + source]
        texts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends[ahead[words.bounds]].astype(np.int64)), pa.py_buffer(out)]
        )
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in rest),
                texts.cast(pa.large_string()).cast(pa.string()),
                pa.array(np.diff(words.bounds)),
                pa.array(row_sums(~kept, words.bounds)),
            ],
            names=[*rest, "text", *_NEW],
        )


def without_earlier_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with the kept words of each text, single blanks between them, and with ``n_words`` and ``n_removed``."""
    names = [c for c in docs.columns if c not in _NEW]
    packed = packed_rest(docs.select(*(F.col(f"`{c}`") for c in names)), doc_id, text)
    keyed = packed.select(F.struct(F.col(doc_id).alias("id"), "_rest").alias("_row"), *document_keys(doc_id, text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A text this short has no window; many of them may share a key.
    able = F.length("text") >= 2 * LENGTH - 1
    spans = earlier_windows(keyed.where(able).select("k1", "k2", "text"), hot, shard_words).distinct()
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    joined = keyed.where(able).join(spans, ["k1", "k2"], "left").select("_row", "text", "spans")
    short = keyed.where(~able).select("_row", "text", F.lit(None).cast(joined.schema["spans"].dataType).alias("spans"))
    rows = joined.unionByName(short)
    schema = rows.select("_row", "text").schema
    for name, kind in _NEW.items():
        schema = schema.add(name, kind)
    out = rows.mapInArrow(lambda it: _apply(it, ["_row"]), schema)
    own = {doc_id: F.col("_row.id"), text: F.col("text")}
    return out.select(*(own.get(c, F.col(f"_row._rest.`{c}`")).alias(c) for c in names), *_NEW)
