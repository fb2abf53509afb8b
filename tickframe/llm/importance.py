"""Quality by importance resampling.

Words, pairs of neighbouring words and the first ``STEM`` characters of words are hashed into ``BUCKETS`` features. Two bag
models are counted over them: of the raw text, over all documents, and of the target, over documents that labels call
good. Their log ratio, summed over a document's features, is L; each feature's ratio is shrunk by ``SHRINK`` expected
occurrences, so what the raw text rarely holds says little. Toxic text hides in the raw mean, hence it gets a model of its
own from the labels: T is the log ratio of target and toxic text over word beginnings that are decisive
(``DECISIVE``). The raw text as a mixture of the target (its share g of the labels), toxic text (share t) and the rest
gives the weight -log(g + (1 - g - t) exp(-L) + t exp(-T)). Gumbel noise from the document's own hash makes the top k
of weight plus noise a sample without replacement in proportion to the weights.

Labels are used up to ``MOST_LABELS`` rows, those of the least hash: a documented bound on what is sent to the workers.
All counts cover all documents whole. Each task adds up its own counts; what is shuffled and what reaches the driver has a
fixed size per task and in total. The k-th key is found exactly by counting 16 bits of the keys at a time.

A null or wordless text has L = T = 0. Rows that repeat id and text get the same noise; keys equal to the k-th are all
kept. Null labels and ids without a document are passed over; without any good label all weights are equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Words, digests, document_keys, mixed, settled, slices

BUCKETS = 1 << 18
STEM = 5
SHRINK = 16.0
MOST_LABELS = 100_000
TOXIC_SHRINK, DECISIVE = 2.0, -1.5
#: What the sample takes beyond the share of good labels.
TOLERANCE = 0.03
#: Columns of counts: raw, target, target's and toxic text's word beginnings.
_COLUMNS = 4
SEED = 17
_CHUNK = 4096


def _features(words: Words) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and row of every word's beginning, every word and every pair of neighbours; how many are beginnings."""
    codes, values = words.encoded()
    of = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    if not len(codes):
        return codes, of, 0
    hashes = digests(values)[codes]
    begun = pc.utf8_slice_codeunits(values.cast(pa.large_string()), 0, STEM).dictionary_encode()
    stems = mixed(digests(begun.dictionary.cast(pa.large_binary())))[begun.indices.to_numpy(zero_copy_only=False)][codes]
    whole = of[:-1] == of[1:]
    pairs = mixed(hashes[:-1] ^ mixed(hashes[1:]))[whole]
    found = np.concatenate((stems, hashes, pairs)) & np.uint64(BUCKETS - 1)
    return found.astype(np.int64), np.concatenate((of, of, of[:-1][whole])), len(codes)


def _counts(docs: DataFrame, good: np.ndarray, toxic: np.ndarray, doc_id: str, text: str) -> np.ndarray:
    """Feature counts in the columns of ``_COLUMNS``."""

    def count(batches):
        total = np.zeros((BUCKETS, _COLUMNS), np.int64)
        for batch in slices(batches, text):
            features, of, begun = _features(Words(batch.column(text), lower=True))
            ids = batch.column(doc_id)
            valid, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            is_good, is_toxic = (np.isin(ids, x) & valid for x in (good, toxic))
            stems, of_stems = features[:begun], of[:begun]
            for i, x in enumerate((features, features[is_good[of]], stems[is_good[of_stems]], stems[is_toxic[of_stems]])):
                total[:, i] += np.bincount(x, minlength=BUCKETS)
        parts = total.reshape(-1, _CHUNK * _COLUMNS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["chunk", "counts"]
        )

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["chunk", "counts"]
        )

    schema = "chunk int, counts binary"
    chunks = BUCKETS // _CHUNK
    summed = docs.select(F.col(doc_id).cast("long").alias(doc_id), text).mapInArrow(count, schema)
    out = np.zeros((BUCKETS, _COLUMNS), np.int64)
    for row in summed.repartition(chunks, "chunk").mapInArrow(add, schema).collect():  # 64 rows of a fixed size
        out[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(row.counts, np.int64).reshape(-1, _COLUMNS)
    return out


def log_ratios(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every feature the shrunk log ratios of target and raw text, and of target and toxic text where decisive."""
    raw, target, good, toxic = (counts[:, i] for i in range(_COLUMNS))
    if not target.any():
        return np.zeros(len(raw)), np.zeros(len(raw))
    against_raw = np.log((target + SHRINK) / (raw * (target.sum() / raw.sum()) + SHRINK))
    against_toxic = np.log((good * (toxic.sum() / max(1, good.sum())) + TOXIC_SHRINK) / (toxic + TOXIC_SHRINK))
    return against_raw, np.where(against_toxic < DECISIVE, against_toxic, 0.0)


def known_labels(labels: DataFrame, doc_id: str = "doc_id", most: int = MOST_LABELS) -> tuple[np.ndarray, np.ndarray, float, float]:
    """From a bounded sample of the labels: ids of good (quality 1, not toxic) and of toxic texts of quality 1.

    And the shares of good and toxic among all labels.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col("quality").isNotNull())
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    rows = known.select(
        F.col(doc_id).cast("long").alias("id"), (toxic & (F.col("quality") == 1)).alias("toxic"), (~toxic & (F.col("quality") == 1)).alias("good")
    )
    shares = rows.agg(*(F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)) for c in ("good", "toxic"))).first()
    chosen = rows.orderBy(F.xxhash64("id"), "id", "toxic", "good").limit(most).where("good or toxic").collect()
    ids = lambda kind: np.unique(np.array([r.id for r in chosen if r[kind]], np.int64))
    return ids("good"), ids("toxic"), *shares


def weigh(docs: DataFrame, known: tuple, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``log_weight`` and ``key`` (weight plus Gumbel noise); ``known`` of ``known_labels``."""
    good, toxic, share, toxic_share = known
    against_raw, against_toxic = log_ratios(_counts(docs, good, toxic, doc_id, text))
    mix = np.log(np.maximum([share, 1 - share - toxic_share, toxic_share], 1e-9))
    names = [c for c in docs.columns if c not in (text, "log_weight", "key", "_h")]
    keyed = docs.select(*names, text, F.xxhash64(*document_keys(doc_id, text), F.lit(SEED)).alias("_h"))
    schema = docs.select(*names).schema.add("log_weight", "double").add("key", "double")

    def run(batches):
        for batch in slices(batches, text):
            features, of, begun = _features(Words(batch.column(text), lower=True))
            n = batch.num_rows
            l = np.bincount(of, weights=against_raw[features], minlength=n).astype(np.float64)  # noqa: E741
            t = np.bincount(of[:begun], weights=against_toxic[features[:begun]], minlength=n).astype(np.float64)
            weight = -np.logaddexp(mix[0], np.logaddexp(mix[1] - l, mix[2] - t))
            uniform = ((batch.column("_h").to_numpy().view(np.uint64) >> np.uint64(11)) + 0.5) / float(1 << 53)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(weight), pa.array(weight - np.log(-np.log(uniform)))],
                names=[*names, "log_weight", "key"],
            )

    return keyed.mapInArrow(run, schema)


def _ordered(key: str) -> Column:
    """A double as a long of the same order, for doubles below 2**39: whole units and 2**-24 of a unit."""
    return F.floor(F.col(key) * (1 << 24)).cast("long")


def kth_largest(rows: DataFrame, k: int, column: str) -> int | None:
    """The k-th largest value of a long column, exact: counts of 16 bits at a time, at most 65,536 of them."""
    if k <= 0:
        return None
    prefix: int | None = None
    for shift in (48, 32, 16, 0):
        own = rows if prefix is None else rows.where(F.shiftright(column, shift + 16) == prefix)
        counts = own.groupBy(F.shiftright(column, shift).alias("p")).agg(F.count("*").alias("n")).collect()
        for row in sorted(counts, key=lambda r: -r.p):
            if row.n >= k:
                prefix = row.p
                break
            k -= row.n
        else:
            return None  # fewer rows than k: all are kept
    return prefix


def resample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, doc_id: str = "doc_id", text: str = "text", most: int = MOST_LABELS
) -> DataFrame:
    """``docs`` without the text, with ``log_weight``, ``key`` and ``kept``: whether the row is in the sample.

    The sample holds ``share`` of the rows; by default the share of good labels and ``TOLERANCE`` more.
    """
    known = known_labels(labels, most=most)
    weighed = settled(weigh(docs, known, doc_id, text), "weights")
    if share is None:
        share = min(1.0, known[2] + TOLERANCE) if len(known[0]) else 1.0
    k = round(weighed.count() * share)
    ordered = weighed.withColumn("_o", _ordered("key"))
    least = kth_largest(ordered, k, "_o")
    kept = F.lit(k > 0) if least is None else F.col("_o") >= least
    return ordered.withColumn("kept", kept).drop("_o")
