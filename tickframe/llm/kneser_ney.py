"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark, stored as sorted hash arrays.

Training counts words, then pairs of neighbouring words (a text opens with a begin mark and closes with an end token).
Workers combine what a partition holds before anything is shuffled, and ship pair counts as compressed sorted arrays.
A word's number is the rank of its hash. A pair's place is the running count of its first word plus a hash of its second
within that word's count; a shard is a stretch of places, so shards are of one size and a word with a third
of all occurrences spreads over many. A shard's sorted keys and counts are files in ``folder``, written under a
temporary name and then renamed, so a task that runs again writes the same file again.

Scoring is a map: workers map the files into memory and look up sorted queries shard by shard. The driver holds sums and
one size per shard only.

p(w | u) = max(c(uw) - D, 0) / c(u) + (D1 N1(u) + D2 N2(u) + D3 N3(u)) / c(u) * p(w), with the discounts of the counts
1, 2 and 3 or more estimated from counts of counts, and p(w) built the same way from the numbers of different words
before w, interpolated with 1 / (V + 1) for each known word and one unknown. A context never seen gives p(w).

Null texts are empty: one end token. Null ids count as empty text when the training part is chosen. Repeated rows count
and are scored each for itself. Without training texts all probabilities are uniform.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.common import Words, digests, mixed, new_folder, settled, signed, slices

#: Tokens whose pairs share a shard, words that share a file of hashes, words that share a file of a column.
SHARD = 2_000_000
WORDS = 1_000_000
STRETCH = 1 << 17
#: Different keys a task gathers before it sends them on.
_GATHER = 1_500_000
_TEXT = 2 << 20
#: Hash of the end token: of a string that no word equals.
_END = int(digests(pa.array([b" "], pa.large_binary())).view(np.int64)[0])


def part(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 7."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7


def mounted(folder: str) -> str:
    """The path under which all machines see a folder."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    if "://" in folder:
        raise ValueError(f"{folder} can't be mapped into memory: name a model folder that is mounted on all machines")
    return folder


def _write(folder: str, name: str, values: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    values.tofile(draft)
    os.replace(draft, f"{folder}/{name}")


def _mapped(path: str, kind: str) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


class Sums:
    """Sums by key of what a task meets, kept sorted; handed on when ``_GATHER`` keys have come together."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        """Whether it is time to hand on."""
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > _GATHER:
            keys, counts = self.taken()
            self.parts, self.size = [(keys, counts)], len(keys)
        return self.size > _GATHER // 2

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        return summed(keys, counts)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _planes(values: np.ndarray) -> bytes:
    """Compressed, byte by byte of all values in turn: high bytes of sorted differences are mostly zero."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def _unplanes(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


_PACKED = "shard long, keys binary, counts binary"


def packed(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray) -> pa.RecordBatch:
    """One row for each shard with its sorted keys as differences, and their counts."""
    order = np.lexsort((keys, shards))
    keys, counts, shards = keys[order], counts[order], shards[order]
    first = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1])))
    spans = list(zip(first.tolist(), np.append(first[1:], len(keys)).tolist()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shards[first], pa.int64()),
            pa.array([_planes(np.diff(keys[a:b], prepend=np.int64(0))) for a, b in spans], pa.binary()),
            pa.array([_planes(counts[a:b].astype(np.int64)) for a, b in spans], pa.binary()),
        ],
        names=["shard", "keys", "counts"],
    )


def merged(batches):
    """(shard, keys, counts) of packed rows that come sorted by shard; one shard is held at a time."""
    shard, parts = None, []
    for batch in batches:
        for now, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "keys", "counts"))):
            if now != shard and parts:
                yield shard, *summed(*(np.concatenate(x) for x in zip(*parts)))
                parts = []
            shard = now
            parts.append((np.cumsum(_unplanes(keys, np.int64)), _unplanes(counts, np.int64)))
    if parts:
        yield shard, *summed(*(np.concatenate(x) for x in zip(*parts)))


def _by_shard(rows: DataFrame, shards: int) -> DataFrame:
    return rows.repartition(max(1, min(shards, 4096)), "shard").sortWithinPartitions("shard")


def _tokens(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words and the end; per token its index there; bounds of each text's tokens."""
    words = Words(batch.column(text), lower=True)
    codes, values = words.encoded()
    hashes = np.append(signed(digests(values.cast(pa.large_binary()))), _END)
    ends = words.bounds[1:]
    tokens = np.insert(codes, ends - words.bounds[0], len(hashes) - 1)
    return hashes, tokens, words.bounds + np.arange(batch.num_rows + 1)


class Model:
    """Sizes, discounts and the folder of the arrays; what workers need to look anything up."""

    def __init__(self, folder: str):
        self.folder = folder
        self.word_bits = 0
        self.word_starts = np.zeros(2, np.int64)
        self.n_words = self.n_tokens = self.n_texts = self.n_pairs = 0
        self.width = 1
        self.pair_discounts = self.word_discounts = np.zeros(4)
        self.word_mass = 1.0

    def word_shards(self, hashes: np.ndarray) -> np.ndarray:
        if not self.word_bits:
            return np.zeros(len(hashes), np.int64)
        return (hashes >> np.int64(64 - self.word_bits)) + (1 << (self.word_bits - 1))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        return self._looked_up(hashes, self.word_shards(hashes), "words")[0]

    def _looked_up(self, keys: np.ndarray, shards: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Place over all shards and count of each key; -1 and 0 where it's missing. Queries go in order."""
        place, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        order = np.lexsort((keys, shards))
        first = np.flatnonzero(np.concatenate(([True], np.diff(shards[order]) != 0))) if len(keys) else []
        for a, b in zip(first, np.append(first[1:], len(keys))):
            own = order[a:b]
            shard = int(shards[own[0]])
            path = f"{self.folder}/{name}-{shard}"
            if not os.path.exists(path):
                continue
            have = _mapped(path, "<i8")
            at = np.searchsorted(have, keys[own])
            hit = at < len(have)
            hit[hit] = have[at[hit]] == keys[own][hit]
            place[own[hit]] = at[hit] + (self.word_starts[shard] if name == "words" else 0)
            wide = os.path.getsize(f"{path}.n") == 8 * len(have)
            counts[own[hit]] = _mapped(f"{path}.n", "<i8" if wide else "<u4")[at[hit]]
        return place, counts

    def column(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values at word numbers (the begin mark is number ``n_words``)."""
        out = np.zeros(len(ids), np.int64)
        order = np.argsort(ids, kind="stable")
        shards = ids[order] // STRETCH
        first = np.flatnonzero(np.concatenate(([True], np.diff(shards) != 0))) if len(ids) else []
        for a, b in zip(first, np.append(first[1:], len(ids))):
            own = order[a:b]
            out[own] = _mapped(f"{self.folder}/{name}-{int(shards[a])}", "<i8")[ids[own] % STRETCH]
        return out

    def pair_shards(self, one: np.ndarray, two: np.ndarray, before: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Shards of pairs, given the running count before the first words and their own counts."""
        within = (mixed(two) % np.maximum(count, 1).astype(np.uint64)).astype(np.int64)
        return (before + within) // self.width


def _pairs(model: Model, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second of every pair; a text's first pair starts with the begin mark."""
    one = np.empty(len(numbers), np.int64)
    one[1:] = numbers[:-1]
    one[bounds[:-1]] = model.n_words
    return one, numbers


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0 to 3; where counts of counts are missing, half of what is usual for the count."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    made = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k) for k, d in enumerate(made, 1))])


def train(docs: DataFrame, text: str = "text", folder: str | None = None) -> Model:
    """Count ``docs`` and write the model's arrays to ``folder``, by default a new one in the shared folder."""
    spark: SparkSession = docs.sparkSession
    model = Model(mounted(folder or new_folder(spark, "kneser-ney")))
    _count_words(docs.select(text), text, model)
    if model.n_tokens:
        _count_pairs(docs.select(text), text, model)
    return model


def _count_words(docs: DataFrame, text: str, model: Model) -> None:
    def count(batches):
        sums = Sums()

        def rows():
            keys, counts = sums.taken()
            for a in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)]), pa.array(counts[a : a + (1 << 16)])], names=["h", "n"])

        for batch in slices(batches, text, _TEXT):
            hashes, tokens, _ = _tokens(batch, text)
            counts = np.bincount(tokens, minlength=len(hashes))
            if sums.add(hashes[counts > 0], counts[counts > 0]):
                yield from rows()
        yield from rows()

    words = docs.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    words = settled(words, "words")
    total = words.agg(
        F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("h") == _END, F.col("n"))), F.lit(0)).alias("t")
    ).first()
    model.n_words, model.n_tokens, model.n_texts = total.v, total.n, total.t
    if total.v >= 1 << 31:
        raise ValueError("more than 2**31 words: pair keys have 64 bits")
    model.word_bits = max(0, (max(1, total.v // WORDS)).bit_length())
    shards = 1 << model.word_bits
    folder = model.folder
    shard = F.shiftright("h", 64 - model.word_bits) + shards // 2 if model.word_bits else F.lit(0).cast("long")

    def store(batches):
        held, now = [], None

        def closed():
            h, n = (np.concatenate(x) for x in zip(*held))
            _write(folder, f"words-{now}", h)
            _write(folder, f"words-{now}.n", n)
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([len(h)]), pa.array([int(n.sum())])], names=["shard", "size", "n"])

        for batch in batches:
            at = batch.column("shard").to_numpy()
            cut = np.flatnonzero(np.diff(at)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
                if a == b:
                    continue
                if now is not None and int(at[a]) != now:
                    yield closed()
                    held = []
                now = int(at[a])
                held.append((batch.column("h").to_numpy()[a:b], batch.column("n").to_numpy()[a:b]))
        if held:
            yield closed()

    ordered = words.withColumn("shard", shard.cast("long")).repartition(shards, "shard").sortWithinPartitions("shard", "h")
    stored = ordered.select("shard", "h", "n").mapInArrow(store, "shard long, size long, n long")
    sizes, before = np.zeros(shards + 1, np.int64), np.zeros(shards + 1, np.int64)
    for row in stored.collect():
        sizes[row.shard + 1], before[row.shard + 1] = row.size, row.n
    model.word_starts = np.cumsum(sizes)
    counts_before = np.cumsum(before)

    # Running counts by word number, in stretches of STRETCH numbers; the begin mark comes last.
    def running(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                low, high = k * STRETCH, min((k + 1) * STRETCH, model.n_words)
                n, start = [], None
                for s in range(np.searchsorted(model.word_starts, low, "right") - 1, shards):
                    a, b = max(low, int(model.word_starts[s])), min(high, int(model.word_starts[s + 1]))
                    if model.word_starts[s] >= high:
                        break
                    if a < b:
                        own = _mapped(f"{folder}/words-{s}.n", "<i8")
                        if start is None:
                            start = counts_before[s] + int(own[: a - model.word_starts[s]].sum())
                        n.append(own[a - model.word_starts[s] : b - model.word_starts[s]])
                start = counts_before[-1] if start is None else start
                n = np.concatenate([*n, [model.n_texts]] if high == model.n_words and low <= model.n_words < low + STRETCH else n)
                _write(folder, f"counts-{k}", n.astype(np.int64))
                _write(folder, f"before-{k}", start + np.cumsum(n, dtype=np.int64) - n.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([k])], names=["id"])

    stretches = model.n_words // STRETCH + 1
    docs.sparkSession.range(stretches).repartition(min(stretches, 4096)).mapInArrow(running, "id long").collect()
    # What a pair's place can reach: every token but the ends opens a pair, and so does every begin mark.
    model.width = SHARD


def _count_pairs(docs: DataFrame, text: str, model: Model) -> None:
    folder = model.folder
    shards = (model.n_tokens + model.n_texts) // model.width + 1

    def count(batches):
        sums = Sums()

        def rows():
            keys, counts = sums.taken()
            if len(keys):
                one, two = keys >> np.int64(32), keys & np.int64(0xFFFFFFFF)
                yield packed(keys, counts, model.pair_shards(one, two, model.column("before", one), model.column("counts", one)))

        for batch in slices(batches, text, _TEXT):
            hashes, tokens, bounds = _tokens(batch, text)
            numbers = model.numbers(hashes)
            one, two = _pairs(model, numbers[tokens], bounds)
            keys, counts = np.unique((one << np.int64(32)) | two, return_counts=True)
            if sums.add(keys, counts):
                yield from rows()
        yield from rows()

    def store(batches):
        """Write each shard; send on, by word: different words before it (0), and its pairs counted 1, 2, more (1 to 3)."""
        for shard, keys, counts in merged(batches):
            _write(folder, f"pairs-{shard}", keys)
            # Half the width where no count needs more; the file's size tells.
            _write(folder, f"pairs-{shard}.n", counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.int64))
            one, two = keys >> np.int64(32), keys & np.int64(0xFFFFFFFF)
            sent, many = np.unique(np.concatenate((two * 4, one * 4 + np.minimum(counts, 3))), return_counts=True)
            yield packed(sent, many, sent // 4 // STRETCH)
            of = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
            yield packed(np.arange(1, 5), of, np.full(4, -1))

    def spread(batches):
        """Dense columns by word number; of the words, how many have 1 to 4 and more different words before them."""
        for shard, keys, counts in merged(batches):
            if shard < 0:
                yield pa.RecordBatch.from_arrays([pa.array([-1] * len(keys)), pa.array(keys), pa.array(counts)], names=["shard", "k", "n"])
                continue
            size = min(STRETCH, model.n_words + 1 - shard * STRETCH)
            table = np.zeros((4, size), np.int64)
            table[keys % 4, keys // 4 - shard * STRETCH] = counts
            for i, name in enumerate(("follows", "once", "twice", "often")):
                _write(folder, f"{name}-{shard}", table[i])
            of = np.bincount(np.minimum(table[0], 5), minlength=6)[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * 6), pa.array(range(1, 7)), pa.array([*of.tolist(), int(table[0].sum())])], names=["shard", "k", "n"]
            )

    pairs = docs.mapInArrow(count, _PACKED)
    sent = settled(_by_shard(pairs, shards).mapInArrow(store, _PACKED), "pair-sums")
    found = _by_shard(sent, model.n_words // STRETCH + 2).mapInArrow(spread, "shard long, k long, n long")
    sums = {(r.shard, r.k): r.n for r in found.groupBy("shard", "k").agg(F.sum("n").alias("n")).collect()}
    of_pairs, of_words = ([sums.get((s, k), 0) for k in range(1, 7)] for s in (-1, 0))
    model.n_pairs = of_words[5]
    model.pair_discounts = _discounts(*of_pairs[:4])
    model.word_discounts = _discounts(*of_words[:4])
    kinds = np.array([of_words[0], of_words[1], sum(of_words[2:5])])
    model.word_mass = float((model.word_discounts[1:] * kinds).sum() / model.n_pairs)


def _probabilities(model: Model, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """p(two | one) for word numbers, -1 for unknown words."""
    uniform = 1 / (model.n_words + 1)
    if not model.n_tokens:
        return np.full(len(two), uniform)
    p = np.full(len(two), model.word_mass * uniform)
    known = np.flatnonzero(two >= 0)
    follows = model.column("follows", two[known])
    p[known] += np.maximum(follows - model.word_discounts[np.minimum(follows, 3)], 0) / model.n_pairs
    at = np.flatnonzero(one >= 0)
    first = one[at]
    total = model.column("counts", first)
    rest = sum(model.pair_discounts[k] * model.column(name, first) for k, name in ((1, "once"), (2, "twice"), (3, "often")))
    pair = np.zeros(len(at), np.int64)
    both = np.flatnonzero(two[at] >= 0)
    u, w = first[both], two[at][both]
    shards = model.pair_shards(u, w, model.column("before", u), total[both])
    pair[both] = model._looked_up((u << np.int64(32)) | w, shards, "pairs")[1]
    p[at] = np.maximum(pair - model.pair_discounts[np.minimum(pair, 3)], 0) / total + rest / total * p[at]
    return p


_NEW = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens``, ``n_known``, ``base_score`` (add-one words) and ``score``.

    Scores are log10 probabilities of whole texts; perplexity is 10 ** (-score / n_tokens).
    """
    names = [c for c in docs.columns if c != text and c not in _NEW]
    schema = docs.select(*names).schema
    for name, kind in _NEW.items():
        schema = schema.add(name, kind)

    def run(batches):
        for batch in slices(batches, text, _TEXT):
            hashes, tokens, bounds = _tokens(batch, text)
            numbers, counts = model._looked_up(hashes, model.word_shards(hashes), "words")
            base = np.log10((counts + 1) / (model.n_tokens + model.n_words + 1))
            one, two = _pairs(model, numbers[tokens], bounds)
            logs = np.log10(_probabilities(model, one, two))
            per_text = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  no text is without a token
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(np.diff(bounds)),
                    pa.array(per_text((counts > 0).astype(np.int64)[tokens])),
                    pa.array(per_text(base[tokens])),
                    pa.array(per_text(logs)),
                ],
                names=[*names, *_NEW],
            )

    return docs.select(*names, text).mapInArrow(run, schema)
