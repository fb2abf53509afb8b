"""The FM-index against plain search, and substring dedup over words against brute force."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import fm_dedup, plans

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(docs, length=fm_dedup.LENGTH):
    """Rows by ascending id: words covered by a window that starts earlier go."""
    seen = set()
    for d, text in docs:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        yield d, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()


def got(df):
    rows = df.withColumn("h", F.sha2("text", 256)).collect()
    return collections.Counter((r.doc_id, r.n_words, r.n_removed, r.h) for r in rows)


def test_whole_table(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    rows = collections.Counter(tuple(r) for r in plans.op12_substrings(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert rows == collections.Counter(cut(docs))


def test_ranks():
    rng = np.random.default_rng(3)
    for n_symbols, size in ((1, 5), (2, 64), (7, 200), (300, 1000)):
        values = rng.integers(0, n_symbols, size)
        waves = fm_dedup.WaveletMatrix(values, n_symbols)
        at, symbols = rng.integers(0, size + 1, 500), rng.integers(0, n_symbols, 500)
        ranks = waves.descend(at, symbols) - waves.descend(np.zeros(500, np.int64), symbols)
        assert ranks.tolist() == [int((values[:a] == c).sum()) for a, c in zip(at, symbols)]


def test_matching_statistics():
    rng = random.Random(5)
    pieces = [[rng.randint(1, 3) for _ in range(rng.randint(1, 12))] for _ in range(40)]
    text = np.array([x for p in pieces for x in (*p, 0)])
    index = fm_dedup.FmIndex(text, 12)
    ends = np.array([i + 1 for i, x in enumerate(text) if x])
    longest = 6

    def occurs(a, b):
        return sum(bool((text[i : i + b - a] == text[a:b]).all()) for i in range(len(text) - (b - a) + 1))

    want = []
    for e in ends.tolist():
        start, n = max(i for i in range(e) if i == 0 or text[i - 1] == 0), 0
        while n < longest and e - n > start and occurs(e - n - 1, e) > 1:
            n += 1
        want.append(n)
    # Only ends that have enough words of their piece before them are asked for.
    able = np.array([e for e in ends.tolist() if 0 not in text[max(0, e - longest) : e] and e >= longest])
    reached, alive, low, high = index.matches(text, able, longest)
    assert reached.tolist() == [w for e, w in zip(ends.tolist(), want) if e in set(able.tolist())]
    for e, lo, hi in zip(able[alive].tolist(), low.tolist(), high.tolist()):
        assert sorted(index.places[lo:hi].tolist()) == [i for i in range(len(text) - longest + 1) if (text[i : i + longest] == text[e - longest : e]).all()]


@pytest.mark.parametrize(("hot", "shard"), [(fm_dedup.HOT, fm_dedup.SHARD_WORDS), (2, 200), (fm_dedup.HOT, 60)])
def test_repeats(spark, hot, shard):
    """Shared passages of any length in own surroundings, exact copies, texts of one word, overlaps within a text."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["é", "Ω"]
    shared = [rng.choices(words, k=rng.randint(15, 120)) for _ in range(10)]
    rows = []
    for i in range(120):
        out = []
        for p in rng.choices(shared, k=rng.randint(0, 4)):
            a = rng.randint(0, 30)
            out += rng.choices(words, k=rng.randint(0, 9)) + p[a : a + rng.choice([19, 20, 21, 40, 200])]
        rows.append((i, rng.choice(" \n\t").join(out)))
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(300, "a " * 700), (301, "a b " * 100), (302, "a " * 19), (303, None), (304, ""), (305, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(fm_dedup.without_earlier_text(df, hot=hot, shard_words=shard)) == collections.Counter(cut(rows))


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60))
    rows = [(1, long, "a"), (1, long, "b"), (None, long, "c"), (None, None, "d"), (2, long + " tail", "e"), (3, "", "f")]
    df = spark.createDataFrame([(*r, "z", "z", "z") for r in rows], "doc_id long, text string, k1 string, spans string, n_words string, first string")
    out = fm_dedup.without_earlier_text(df)
    assert out.columns == ["doc_id", "text", "k1", "spans", "first", "n_words", "n_removed"]
    by = collections.Counter((r.doc_id, r.k1, r.text, r.n_words, r.n_removed) for r in out.collect())
    # The row without id comes first; rows that repeat id and text share their fate.
    assert by == {(None, "c", long, 60, 0): 1, (1, "a", "", 60, 60): 1, (1, "b", "", 60, 60): 1, (None, "d", "", 0, 0): 1, (2, "e", "tail", 61, 60): 1, (3, "f", "", 0, 0): 1}
    assert fm_dedup.without_earlier_text(df.limit(0)).count() == 0
    twice = df.where("doc_id = 1")
    assert {r.n_removed for r in fm_dedup.without_earlier_text(twice).collect()} == {0}


def test_pieces_of_long_texts(spark, monkeypatch):
    """Where a text is parsed in several stretches, cuts between them lose nothing."""
    rng = random.Random(2)
    body = [f"v{rng.randint(0, 400)}" for _ in range(3000)]
    rows = [(0, " ".join(body)), (1, " ".join(["own"] * 7 + body[500:2500])), (2, " ".join(body[1000:1100]))]
    monkeypatch.setattr(fm_dedup, "_PIECE", 333)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = np.array([hash(w) & 0xFFFFFFFF for w in body], np.uint64)
    found = list(fm_dedup._pieces(hashes, np.array([0, len(body)])))
    assert sum(int(n.sum()) for _, n, *_ in found) == len(body) - fm_dedup.LENGTH + 1
    assert got(fm_dedup.without_earlier_text(df)) == collections.Counter(cut(rows))
