"""Ranked search against scores of every document."""

import collections
import math
import random
import re

import pytest

from tickframe.llm import presence_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=20):
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()}
    out = []
    for i, text in items:
        found = []
        for d, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n // total
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t])
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, rank, d, -score) for rank, (score, _, d) in enumerate(found[:top], 1)]
    return collections.Counter(out)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return collections.Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_DOCS": 13}, {"BLOCK_COUNTS": 40, "SPREAD": 2}])
@pytest.mark.parametrize("block_terms", [100_000, 30])
def test_ranks(spark, monkeypatch, sizes, block_terms):
    """Common and rare words, ties, copies, items of more than 64 terms."""
    for name, value in sizes.items():
        monkeypatch.setattr(presence_search, name, value)
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(200)] + ["É", "Straße", "x1", "über", "ABC", "日本"]
    weights = [1 / (1 + i) for i in range(len(vocabulary))]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(300)]
    docs += [(400 + i, docs[5][1]) for i in range(60)] + [(500, "w3 " * 5000), (501, None), (502, "..."), (None, docs[5][1]), (503, docs[5][1].upper())]
    items = [(i, text(rng.randint(1, 30))) for i in range(12)] + [(20, " ".join(vocabulary)), (21, docs[5][1]), (22, "unknown"), (23, None), (24, "w0 w0 W0")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = presence_search.search(df, spark.createDataFrame(items, "item_id long, text string"), block_terms=block_terms)
    assert got(found) == ranked(docs, items)


def test_edges(spark):
    docs = [(1, "one two"), (1, "one two"), (None, "two three"), (3, None), (4, "")]
    items = [(7, "one"), (7, "one"), (7, "two three"), (None, "three"), (8, "")]
    df = spark.createDataFrame([(*d, "z", "z", "z") for d in docs], "doc_id long, text string, item_id string, score string, rank string")
    queries = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    found = got(presence_search.search(df, queries))
    assert found == ranked(docs, [(7, "one"), (7, "two three"), (None, "three"), (8, "")])
    assert presence_search.search(df.limit(0), queries).count() == 0 and presence_search.search(df, queries.limit(0)).count() == 0


def test_masks_end_early(spark, monkeypatch):
    """Whole scores are taken of few documents: masks whose bound is under the last rank are passed over."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    rows = [(i, 10, sorted(rng.sample(range(12), 3))) for i in range(2000)] + [(5000 + i, 10, [0, 1, 2, 3, 4]) for i in range(30)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": [r[0] for r in rows], "n": [r[1] for r in rows], "terms": pa.array([r[2] for r in rows], pa.list_(pa.int32())), "tfs": pa.array([[1] * len(r[2]) for r in rows], pa.list_(pa.int64()))}
    )
    postings = presence_search._Postings([batch], len(rows), 10 * len(rows), 12)
    taken, scores = [], presence_search._Postings.scores
    monkeypatch.setattr(presence_search._Postings, "scores", lambda self, own, w, chosen: taken.append(len(chosen)) or scores(self, own, w, chosen))
    best = presence_search._Ranked(20)
    presence_search._search(postings, np.arange(5), np.full(5, 1000), best)
    assert best.ids.tolist() == list(range(5000, 5020)) and sum(taken) < 200
