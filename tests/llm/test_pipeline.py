"""The pipeline against a brute-force version of its stages."""

import collections

import duckdb
import numpy as np
import pyarrow as pa

import corpus_pipeline
from test_queries import SF, WORD, clusters, simhash
from tickframe.llm import decontam, rule_ledger
from tickframe.llm.common import Words

FIELDS = "doc_id, text, lang, source, n_chars"


def lines_cut(docs, least=50):
    """Lines inside any run of ``least`` words or more, however long, whose lines also start earlier, go from (doc_id, text)."""
    seen, numbers, out = set(), {}, {}
    for d, text in docs:
        every = text.split("\n")
        own = [(i, line) for i, line in enumerate(every) if WORD.search(line)]
        sizes = [len(WORD.findall(line)) for _, line in own]
        ids = [numbers.setdefault(line, len(numbers) + 1) for _, line in own]
        gone = set()
        for a in range(len(own)):
            run, total = 0, 0
            for b in range(a, len(own)):
                run, total = (run * 1_000_003 + ids[b]) % ((1 << 127) - 1), total + sizes[b]
                if total >= least:
                    if (b - a, run) in seen:
                        gone.update(range(a, b + 1))
                    seen.add((b - a, run))
        if not gone:
            out[d] = text
        elif len(gone) < len(own):
            dead = {own[k][0] for k in gone}
            kept, before = [], False
            for i, line in enumerate(every):
                before = i in dead if WORD.search(line) else before
                if not before:
                    kept.append(line)
            out[d] = "\n".join(kept)
    return out


def test_pipeline(spark):
    rows = duckdb.sql(f"SELECT {FIELDS} FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    source = {r[0]: r[3] for r in rows}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stems = rule_ledger.learned_stems(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    entries = {r.doc_id: r.fail_bits for r in rule_ledger.ledger(docs, blocked_stems=stems).collect()}
    texts = {r[0]: r[1] for r in rows if not entries[r[0]] & rule_ledger.POLICIES[rule_ledger.CURRENT]}
    texts = lines_cut(sorted(texts.items()))
    component = clusters({d: simhash(t, corpus_pipeline.NEAR_WORDS) for d, t in texts.items()})
    texts = {d: t for d, t in texts.items() if component[d] == d}

    numbers = {}

    def tokens(text):
        words = Words(pa.array([text or ""], pa.large_string()), lower=True, space=decontam._BREAK).words.to_pylist()
        return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)

    items = [tokens(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    clean = {d for d, t in texts.items() if all(decontam.align(x, tokens(t))[0] < len(x) for x in items)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.text for r in got} == {d: texts[d] for d in clean}
    assert all(r.source == source[r.doc_id] and r.n_chars == len(r.text) for r in got)
    assert len({r.mix_position for r in got}) == len(got) == len(clean)
    assert max(collections.Counter(r.mix_slot for r in got).values()) <= 16
