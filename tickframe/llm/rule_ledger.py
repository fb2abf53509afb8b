"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: the ledger keeps the measurements and one failure bit per rule. A policy is a
versioned mask of rejecting bits, applied later by one bitwise test, so policies can change without reading texts
again; ablations aggregate the bits.

Words of insult come from a list and, where labels are given, from the texts that labels call toxic: word beginnings that
at least ``MIN_TOXIC`` toxic texts hold, and that are ``TOXIC_ODDS`` times rarer in clean ones. They are learned from up to
``MOST_LABELS`` labelled rows (those of the least hash), the documented bound of what is sent to the workers.

Measuring is a map over Arrow batches without a shuffle. A null or empty text has no words and fails ``few_words``;
repeated rows are measured each for itself; an empty table gives an empty ledger. Further input columns are carried
along unless they bear the name of a ledger column, in which case they are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Words, cut_out, mixed, row_sums, slices, window_hashes, worded_lines

WINDOW_WORDS = 8

#: Insults of the blocked-words rule; a parameter of the ledger.
BLOCKED_WORDS = (
    "arsehole asshole bastard bitch clown crap creep disgusting dumbass fool garbage idiot imbecile jerk loser moron pathetic "
    "retard scum scumbag stupid trash ugly vermin worthless"
).split()

#: Code points of a word's beginning that may be blocked, and of the shortest word that counts.
STEM, SHORTEST = 5, 4
MIN_TOXIC, TOXIC_ODDS, MOST_LABELS, MOST_STEMS = 5, 50, 100_000, 100_000

MEASURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_letters n_symbol_words n_shouted n_blocked "
    "n_stutter"
).split()


#: Rules in the order of their bits; new rules go to the end, so stored bits keep their meaning.
RULES = (
    "few_words repeated_words symbol_words symbols shouting upper_case duplicate_lines long_words blocked_words "
    "stutter"
).split()


def _per_word(share: float, measure: str) -> Column:
    return F.col(measure) > share * F.col("n_words")


def failures() -> list[Column]:
    """When a document fails, for each of ``RULES``."""
    return [
        F.col("n_words") < 20,
        100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        _per_word(0.3, "n_symbol_words"),
        _per_word(0.3, "n_symbols"),
        (F.col("n_words") > 0) & _per_word(0.4, "n_shouted"),
        (F.col("n_letters") > 0) & (F.col("n_upper") > 0.5 * F.col("n_letters")),
        F.col("n_dup_lines") > 0.5 * F.col("n_lines"),
        (F.col("n_words") > 0) & (F.col("word_chars") > 25 * F.col("n_words")),
        (F.col("n_blocked") >= 2) & (500 * F.col("n_blocked") >= F.col("n_words")),
        (F.col("n_words") > 0) & _per_word(0.3, "n_stutter"),
    ]


def mask(*names: str) -> int:
    """The bits of the named rules."""
    return sum(1 << RULES.index(name) for name in names)


#: The base: what every policy rejects.
BASE = mask("few_words", "repeated_words")

#: Versioned policies; never change a published one, add the next.
POLICIES = {
    "base": BASE,
    "v1": BASE | mask("symbol_words", "symbols", "shouting", "upper_case", "duplicate_lines"),
    "v2": BASE | mask("symbol_words", "symbols", "shouting", "upper_case", "duplicate_lines", "long_words", "blocked_words", "stutter"),
}
CURRENT = "v2"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_LOUD = np.zeros(256, dtype=bool)
_LOUD[ord("!")] = True


def _line_measures(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line of their text."""
    n = len(words.offsets) - 1
    starts, ends, of = worded_lines(words)
    lines = cut_out(words.data, starts, ends)
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.unique(of * (int(codes.max(initial=0)) + 1) + codes, return_index=True)[1]
    total = np.bincount(of, minlength=n)
    return total, total - np.bincount(of[first], minlength=n)


def _repeated(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words inside windows of eight that their own text holds twice or more."""
    n = len(bounds) - 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    found = window_hashes(codes, WINDOW_WORDS)
    whole = of[: len(found)] == of[WINDOW_WORDS - 1 :][: len(found)]
    at = np.flatnonzero(whole)
    keys = mixed(found[at] ^ mixed(of[at]))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(codes) + 1, dtype=np.int64)
    starts = at[twice]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW_WORDS, -1)
    return row_sums(np.cumsum(edges[:-1]) > 0, bounds)


def _stems(values: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words without case (A-Z) and outer punctuation, and their beginnings, null for short words."""
    plain = pc.ascii_trim(pc.ascii_lower(values.cast(pa.large_string())), characters=".,;:!?\"'()[]#*$%&|<>")
    stems = pc.utf8_slice_codeunits(plain, 0, STEM)
    return plain, pc.if_else(pc.greater_equal(pc.utf8_length(plain), SHORTEST), stems, pa.scalar(None, pa.large_string()))


def learned_stems(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """Word beginnings that mark toxic texts: counted over texts of quality 1, toxic against clean."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.col("quality") == 1))
    sample = known.select(F.col("doc_id").cast("long").alias("_id"), (F.col("toxic") == 1).alias("_toxic"))
    sample = sample.orderBy(F.xxhash64("_id"), "_id", "_toxic").limit(MOST_LABELS)
    chosen = docs.select(F.col(doc_id).alias("_id"), text).join(F.broadcast(sample), "_id").select(text, "_toxic")

    def count(batches):
        total: dict[str, list[int]] = {}
        for batch in slices(batches, text):
            words = Words(batch.column(text))
            codes, values = words.encoded()
            made = _stems(values)[1].dictionary_encode()
            stem = made.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[codes] if len(codes) else codes
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.bounds))
            n = len(made.dictionary)
            pairs = np.unique(row[stem >= 0] * n + stem[stem >= 0])
            toxic = batch.column("_toxic").to_numpy(zero_copy_only=False).astype(bool)[pairs // max(1, n)]
            found = np.stack((np.bincount(pairs[toxic] % max(1, n), minlength=n), np.bincount(pairs[~toxic] % max(1, n), minlength=n)))
            for name, a, b in zip(made.dictionary.to_pylist(), *found.tolist()):
                own = total.setdefault(name, [0, 0])
                own[0] += a
                own[1] += b
            if len(total) > 1_000_000:
                yield _stem_rows(total)
                total = {}
        yield _stem_rows(total)

    counts = chosen.mapInArrow(count, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    marked = counts.where((F.col("t") >= MIN_TOXIC) & (TOXIC_ODDS * F.col("c") <= F.col("t"))).select("stem").limit(MOST_STEMS + 1).collect()
    if len(marked) > MOST_STEMS:
        raise ValueError("too many toxic word beginnings; raise MIN_TOXIC")
    return sorted(r.stem for r in marked)


def _stem_rows(total: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), *(pa.array([x[i] for x in total.values()], pa.int64()) for i in range(2))],
        names=["stem", "toxic", "clean"],
    )


def _measured(batch: pa.RecordBatch, text: str, blocked: pa.Array, stems: pa.Array) -> dict[str, np.ndarray]:
    words = Words(batch.column(text))
    data, offsets = words.data, words.offsets
    codes, values = words.encoded()
    body, ends = words.body, words.word_offsets
    upper, letters = row_sums(_UPPER[body], ends), row_sums(_LETTER[body], ends)
    symbol = row_sums(_SYMBOL[body], ends) > 0
    loud = (upper > 0) & (upper == letters) & (row_sums(_LOUD[body], ends) > 0)
    plain, begun = _stems(values)
    is_blocked = pc.or_(pc.is_in(plain, value_set=blocked), pc.is_in(begun, value_set=stems)).to_numpy(zero_copy_only=False)
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again[words.bounds[:-1][words.bounds[:-1] < len(codes)]] = False
    n_lines, n_dup = _line_measures(words)
    return {
        "n_words": np.diff(words.bounds),
        "word_chars": row_sums(words.inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": row_sums(_SYMBOL[data], offsets),
        "n_lines": n_lines,
        "n_dup_lines": n_dup,
        "n_repeat_words": _repeated(codes, words.bounds),
        "n_upper": row_sums(_UPPER[data], offsets),
        "n_letters": row_sums(_LETTER[data], offsets),
        "n_symbol_words": row_sums(symbol, words.bounds),
        "n_shouted": row_sums(loud, words.bounds),
        "n_blocked": row_sums(is_blocked[codes], words.bounds) if len(codes) else np.zeros(batch.num_rows, np.int64),
        "n_stutter": row_sums(again, words.bounds),
    }


def measure(docs: DataFrame, text: str = "text", blocked_words: list[str] | None = None, blocked_stems: list[str] = ()) -> DataFrame:
    """``docs`` with the columns of ``MEASURES`` (long), each taken over the whole text."""
    kept = [c for c in docs.columns if c not in {*MEASURES, "fail_bits", "n_failed"}]
    fields = docs.select(*kept).schema
    for name in MEASURES:
        fields = fields.add(name, "long")
    terms = BLOCKED_WORDS if blocked_words is None else blocked_words

    def run(batches):
        blocked, stems = (pa.array(x, pa.large_string()) for x in (terms, blocked_stems))
        for batch in slices(batches, text):
            found = _measured(batch, text, blocked, stems)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=[*batch.schema.names, *MEASURES]
            )

    return docs.select(*kept).mapInArrow(run, fields)


def with_bits(measured: DataFrame) -> DataFrame:
    """The ledger: ``fail_bits`` (bit i is set where rule i fails) and ``n_failed`` beside the measurements."""
    bits = F.lit(0).cast("long")
    for i, fails in enumerate(failures()):
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits).withColumn("n_failed", F.bit_count("fail_bits").cast("long"))


def ledger(docs: DataFrame, text: str = "text", blocked_words: list[str] | None = None, blocked_stems: list[str] = ()) -> DataFrame:
    return with_bits(measure(docs, text, blocked_words, blocked_stems))


def rejected(policy: int | str = CURRENT) -> Column:
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col("fail_bits").bitwiseAND(F.lit(bits)) != 0


def apply_policy(entries: DataFrame, policy: int | str = CURRENT) -> DataFrame:
    """Rows of a ledger that the policy keeps."""
    return entries.where(~rejected(policy))


def ablation(entries: DataFrame, policy: int | str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that stay if the rule is left out.

    The ledger is first counted by its bits, at most two to the number of rules of groups, combined before the shuffle.
    """
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    counts = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(bits)).alias("b")).agg(F.count("*").alias("n"))
    each = [
        F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, name in enumerate(RULES)
        if bits >> i & 1
    ]
    rest = F.col("b").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return (
        counts.select("b", "n", F.explode(F.array(*each)).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("b").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failing"),
            F.sum(F.when(F.col("b") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_failing"),
            F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )
