"""Registered queries against their SQL, and against brute force where SQL can't express them, on whole small tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from tickframe.llm import chat_hmm, kneser_ney, phrase_dedup, pfair, plans
from oracle import TABLES, compare, connect

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_sql(spark, name):
    assert "documents" in TABLES
    assert compare(plans.queries()[name](spark, SF), connect(SF), plans.oracle_sql()[name]) is None


def simhash(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clusters(prints):
    """Least key of each key's component under three differing bits."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    values = np.array([prints[k] for k in keys], np.uint64)
    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3):
            a, b = find(k), find(keys[i + 1 + j])
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_simhash(spark, docs):
    prints = {d: simhash(t, 3) for d, t in docs}
    component = clusters(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in plans.op2_simhash(spark, SF).collect()}
    assert got == {d: (f"{prints[d]:016x}", component[d]) for d in prints}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def test_pii(spark, docs):
    texts = dict(docs)
    for r in plans.op4_pii(spark, SF).collect():
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(spans) and set(spans) <= set(r.spans.split(",")) | {""}


def test_planted_secrets_are_found(spark):
    """Every text of a larger table that holds a quoted token is told by its spans."""
    sf = "/root/testdata/sf0.01"
    planted = {d for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall() if re.search(r'token = "[0-9a-f]{40}"', t or "")}
    got = {r.doc_id for r in plans.op4_pii(spark, sf).collect() if "secret:" in r.spans and r.n_spans}
    assert len(planted) > 5 and planted == got


def cut_repeats(docs, length=phrase_dedup.LENGTH):
    seen = collections.Counter()
    for _, text in docs:
        body = (text or "").encode()
        seen.update(body[i : i + length] for i in range(len(body) - length + 1))
    for d, text in docs:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            if seen[body[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(body) else 0
        yield d, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_suffixes(spark, docs):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in plans.op7_suffixes(spark, SF).collect()]
    assert sorted(got) == sorted(cut_repeats(docs))


def kneser_ney_scores(docs):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    texts = [(d, [*WORD.findall((t or "").translate(LOWER)), None]) for d, t in docs]
    words, pairs, context = collections.Counter(), collections.Counter(), collections.Counter()
    for d, own in texts:
        if not held(d):
            words.update(own)
            for u, w in zip(["<s>", *own], own):
                pairs[u, w] += 1
                context[u] += 1
    n, v = sum(words.values()), len(words)
    before = collections.Counter(w for _, w in pairs)

    def discounts(values):
        of = collections.Counter(min(x, 5) for x in values)
        n = [None, *(of[i] for i in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2])
        return [0.0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k) for k in (1, 2, 3)]

    d2, d1 = discounts(pairs.values()), discounts(before.values())
    kinds = collections.Counter(min(x, 3) for x in before.values())
    mass = sum(d1[i] * kinds[i] for i in (1, 2, 3)) / len(pairs)
    left = collections.Counter()
    for (u, _), c in pairs.items():
        left[u] += d2[min(c, 3)]

    def one(w):
        return max(before[w] - d1[min(before[w], 3)], 0) / len(pairs) + mass / (v + 1)

    def two(u, w):
        if u not in context:
            return one(w)
        c = pairs[u, w]
        return max(c - d2[min(c, 3)], 0) / context[u] + left[u] / context[u] * one(w)

    assert sum(two("<s>", w) for w in words) + two("<s>", "\0never") == pytest.approx(1)
    for d, own in texts:
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own)
        yield d, held(d), len(own), sum(w in words for w in own), n, base, sum(math.log10(two(u, w)) for u, w in zip(["<s>", *own], own))


@pytest.mark.parametrize("sizes", [{}, {"SHARD": 3000, "WORDS": 2000, "STRETCH": 700, "_GATHER": 9000}])
def test_kneser_ney(spark, docs, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(kneser_ney, name, value)
    got = {r.doc_id: r for r in plans.op10_kneser_ney(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, held, tokens, known, n, base, score in kneser_ney_scores(docs):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    held_out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


PUNCTUATION = re.compile(r"[!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~\x20\x09-\x0D]+")


def plain_words(text):
    return [w for w in PUNCTUATION.split((text or "").translate(LOWER)) if w]


def smith_waterman(item, text):
    """Best local score of two lists of word numbers: 2 for a match, -1 for a mismatch or a gap."""
    text, best = np.array(text, np.int64), 0
    above, steps = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for word in item:
        row = np.maximum(above - 1, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == word, 2, -1))
        # A gap along the text costs one a word: the running maximum of the values raised by their place.
        above = np.maximum.accumulate(row + steps) - steps
        best = max(best, int(above.max()))
    return best


def test_leaks(spark, docs):
    """Every text against every item in full, without seeds."""
    numbers = {}
    number = lambda text: [numbers.setdefault(w, len(numbers)) for w in plain_words(text)]
    items = [(i, number(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]
    want = {}
    for d, text in docs:
        own = number(text)
        for i, item in items:
            share = smith_waterman(item, own) / (2 * len(item)) if own and item else 0
            if share >= 0.5:
                want[d, i] = share
    got = {(r.doc_id, r.item_id): r.score for r in plans.op6_decontamination(spark, SF).collect()}
    assert got == pytest.approx(want) and got


def test_mixing(spark):
    rows = plans.op3_mixing(spark, SF).collect()
    sources = collections.Counter(r.source for r in rows)
    assert len({r.mix_position for r in rows}) == len(rows) == sum(sources.values())
    blocks = collections.defaultdict(set)
    for r in rows:
        blocks[r.source].add((r.mix_block, r.mix_slot))
    for s, own in blocks.items():
        assert {b for b, _ in own} == set(range(-(-sources[s] // pfair.BLOCK))) and len({t for _, t in own}) == len(own)


@pytest.mark.parametrize("blocks", [{"a": 7, "b": 2, "c": 1}, {"a": 333, "b": 333, "c": 334}, {"a": 1}, {f"s{i}": 1 + i % 5 for i in range(40)}])
def test_no_source_strays_by_a_block(blocks):
    slots = pfair.schedule(blocks)
    frame = sum(blocks.values())
    assert sorted(t for own in slots.values() for t in own) == list(range(frame))
    for s, own in slots.items():
        for t in range(frame + 1):
            assert abs(sum(x < t for x in own) - t * blocks[s] / frame) < 1


@pytest.mark.parametrize("weights", [{"a": 1.0, "b": 1e-5}, {"a": 0.6663, "b": 0.3337}, {f"s{i}": math.sqrt(3 + 7 * i) for i in range(60)}, {"a": 1.0, "b": 1e-9, "c": 2.0}])
def test_targets_are_met_over_a_long_frame(weights):
    """Less than a block away from the exact weights at every slot of a million, and of the weights given."""
    counts = {s: 10**9 for s in weights}
    slots = pfair._frame(weights, counts, pfair.FRAME, 16)
    length = sum(len(own) for own in slots.values())
    assert length >= pfair.FRAME and sorted(t for own in slots.values() for t in own) == list(range(length))
    total = sum(max(w / sum(weights.values()), 1 / pfair.FRAME) for w in weights.values())
    for s, own in slots.items():
        share = max(weights[s] / sum(weights.values()), 1 / pfair.FRAME) / total
        at, before = np.array(own), np.arange(len(own))
        # Right before and right after each of its blocks a source strays furthest.
        assert np.abs(before - at * share).max() < 1 and np.abs(before + 1 - (at + 1) * share).max() < 1


def test_positions_against_a_loop(spark):
    """Positions of the mix from the frame by hand: blocks of a source in turn, a frame after the other."""
    from pyspark.sql import functions as F

    rows = [(i if i % 3 else None, "abc"[min(i % 5, 2)], f"t{i}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights = {"a": 0.5, "b": 0.375, "c": 0.125}
    got = pfair.mix(df, weights, frame=16, block=3).orderBy("mix_position").collect()
    slots = pfair.schedule({"a": 4, "b": 3, "c": 1}, 16)
    order = sorted((t + 16 * k, s, n + len(own) * k) for s, own in slots.items() for k in range(120) for n, t in enumerate(own))
    left = {s: sum(r[1] == s for r in rows) for s in weights}
    want = [(slot, s, j) for slot, s, j in order for _ in range(min(3, max(0, left[s] - 3 * j)))]
    assert [(r.mix_slot, r.source, r.mix_block) for r in got] == want
    hashes = df.select("source", "text", F.xxhash64("doc_id", "source", "text").alias("h")).collect()
    sizes = collections.Counter(r.source for r in hashes)
    assert all(n <= pfair.BUCKET for n in sizes.values())
    for s in weights:
        assert [r.text for r in got if r.source == s] == [r.text for r in sorted((r for r in hashes if r.source == s), key=lambda r: r.h)]


def test_shares_sum_up():
    for weights in ({"a": 1.0, "b": 1e-9}, {"a": 5, "b": 3, "c": 2}, {str(i): 1 for i in range(7)}):
        got = pfair.shares(weights, 10)
        assert sum(got.values()) == 10 and min(got.values()) >= 1


def splitmix(x):
    x = (x + 0x9E3779B97F4A7C15) % (1 << 64)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % (1 << 64)
    return x ^ (x >> 31)


def test_importance_weights(spark, docs):
    """Weights, keys and the sample from plain dictionaries of hashed words, word pairs and word beginnings."""
    from pyspark.sql import functions as F

    from tickframe.llm import importance
    from tickframe.llm.common import document_keys

    digest = lambda w: xxhash.xxh3_64_intdigest(w.encode())
    bucket = lambda h: h % importance.BUCKETS

    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        stems = [bucket(splitmix(digest(w[: importance.STEM]))) for w in words]
        pairs = [bucket(splitmix(digest(a) ^ splitmix(digest(b)))) for a, b in zip(words, words[1:])]
        return stems, stems + [bucket(digest(w)) for w in words] + pairs

    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF}/labels.parquet' WHERE doc_id IS NOT NULL AND quality IS NOT NULL").fetchall()
    good = {d for d, q, t in labels if q == 1 and t != 1}
    toxic = {d for d, q, t in labels if q == 1 and t == 1}
    g, t = (sum(d in kind for d, *_ in labels) / len(labels) for kind in (good, toxic))
    of = {d: features(x) for d, x in docs}
    raw, target, stems, bad = (collections.Counter() for _ in range(4))
    for d, (own, every) in of.items():
        raw.update(every)
        target.update(every if d in good else ())
        stems.update(own if d in good else ())
        bad.update(own if d in toxic else ())
    scale, bad_scale = sum(target.values()) / sum(raw.values()), sum(bad.values()) / max(1, sum(stems.values()))
    against_raw = lambda f: math.log((target[f] + importance.SHRINK) / (raw[f] * scale + importance.SHRINK))

    def against_toxic(f):
        ratio = math.log((stems[f] * bad_scale + importance.TOXIC_SHRINK) / (bad[f] + importance.TOXIC_SHRINK))
        return ratio if ratio < importance.DECISIVE else 0.0

    def weight(d):
        low, high = sum(map(against_raw, of[d][1])), sum(map(against_toxic, of[d][0]))
        parts = [math.log(max(g, 1e-9)), math.log(max(1 - g - t, 1e-9)) - low, math.log(max(t, 1e-9)) - high]
        top = max(parts)
        return -(top + math.log(sum(math.exp(p - top) for p in parts)))

    table = spark.read.parquet(f"{SF}/documents.parquet")
    noise = {r.doc_id: r.h % (1 << 64) for r in table.select("doc_id", F.xxhash64(*document_keys(), F.lit(importance.SEED)).alias("h")).collect()}
    keys = {d: weight(d) - math.log(-math.log(((noise[d] >> 11) + 0.5) / (1 << 53))) for d in of}
    got = {r.doc_id: r for r in plans.op8_importance(spark, SF).collect()}
    assert {d: r.log_weight for d, r in got.items()} == pytest.approx({d: weight(d) for d in of}, abs=1e-6)
    assert {d: r.key for d, r in got.items()} == pytest.approx(keys, abs=1e-6)
    k = round(len(docs) * min(1.0, g + importance.TOLERANCE))
    assert {d for d, r in got.items() if r.kept} == set(sorted(keys, key=keys.get, reverse=True)[:k])


def test_importance_keeps_good_texts(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = plans.op8_importance(spark, sf).collect()
    kept = collections.Counter((labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels)
    assert kept[(1, 0), True] > 0.95 * (kept[(1, 0), True] + kept[(1, 0), False])
    assert kept[(0, 0), True] < 0.2 * (kept[(0, 0), True] + kept[(0, 0), False])


def best_states(model, observations):
    """Viterbi by its recurrence on plain lists; of equal ways the one from the lesser state."""
    n = len(chat_hmm.STATES)
    score = [model.first[s] + model.shown[s, observations[0]] for s in range(n)]
    ways = []
    for o in observations[1:]:
        came = [max(range(n), key=lambda r: (score[r] + model.step[r, s], -r)) for s in range(n)]  # noqa: B023
        score = [score[came[s]] + model.step[came[s], s] + model.shown[s, o] for s in range(n)]
        ways.append(came)
    state = max(range(n), key=lambda s: (score[s], -s))
    out = [state]
    for came in reversed(ways):
        state = came[state]
        out.append(state)
    return out[::-1]


def recovered(model, lines):
    """Turns of one conversation's lines: first turn and position, role, number of lines, opened by no opening line."""
    out, last = [], None
    for line, state in zip(lines, best_states(model, [r.obs for r in lines])):
        role, opens = chat_hmm.STATES[state]
        if out and not opens and last == role:
            out[-1][3] += 1
        else:
            out.append([line.turn, line.pos, role, 1, not opens])
        last = role
    return [tuple(t) for t in out]


@pytest.mark.parametrize("turns", [64, 2, 1])
def test_chat(spark, monkeypatch, turns):
    """Blocks of any length give the turns of one Viterbi pass over the whole conversation."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(chat_hmm, "TURNS", turns)
    shown = plans.transcripts(spark.read.parquet(f"{SF}/conversations.parquet"))
    model = chat_hmm.fit(shown)
    lines = chat_hmm.lines(shown.drop("role"))
    whole = collections.defaultdict(list)
    for r in lines.orderBy("conv", "turn", "pos").collect():
        whole[r.conv].append(r)
    truth = {(r.conv_id, r.turn): r.role for r in shown.collect()}
    rows = chat_hmm.rendered(chat_hmm.roles(lines, model)).orderBy("conv", "turn", "pos").collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.conv].append((r.turn, r.pos, r.role, r.n_lines, r.continued))
    assert got == {conv: recovered(model, own) for conv, own in whole.items()}
    right = sum(truth[r.conv, r.turn] == r.role for r in rows)
    assert right > 0.8 * len(truth) and all(r.rendered.startswith(f"<|{r.role}|>\n") for r in rows)
    assert lines.agg(F.max("obs")).first()[0] < chat_hmm.N_OBSERVATIONS


@pytest.mark.parametrize("turns", [64, 7, 1])
def test_long_turns_are_whole(spark, monkeypatch, turns):
    """A speaker whose lines come as many source turns, beside rows without an id, equal ones too, and clashing names."""
    monkeypatch.setattr(chat_hmm, "TURNS", turns)
    model = chat_hmm.fit(plans.transcripts(spark.read.parquet(f"{SF}/conversations.parquet")))
    rows = [(1, 0, "User: please go on?")] + [(1, i, f"and so it went, line {i} of it") for i in range(1, 150)] + [(1, 150, "Assistant: Done.")]
    rows += [(None, 3, "User: alone?\nmore")] * 2 + [(None, None, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, text string, own string, block string").repartition(3)
    lines = chat_hmm.lines(df)
    turns_ = chat_hmm.roles(lines, model).collect()
    one = sorted((r.turn, r.n_lines, r.role) for r in turns_ if r.conv == 1)
    ordered = sorted((r for r in lines.collect() if r.conv == 1), key=lambda r: (r.turn, r.pos))
    assert one == [(t, n, role) for t, _, role, n, _ in recovered(model, ordered)] and sum(n for _, n, _ in one) == 151
    bodies = {r.turn: r.text.split("\n") for r in turns_ if r.conv == 1}
    assert [line for t in sorted(bodies) for line in bodies[t]][1:150] == [f"and so it went, line {i} of it" for i in range(1, 150)]
    alone = [r for r in lines.collect() if r.conv is None and r.turn == 3]
    alone = [r for r in alone if r.own == alone[0].own]
    want = [(t, p, role, n) for t, p, role, n, _ in recovered(model, sorted(alone, key=lambda r: r.pos))] * 2
    assert sorted((r.turn, r.pos, r.role, r.n_lines) for r in turns_ if r.conv is None and r.turn == 3) == sorted(want)
    assert [r.text for r in turns_ if r.turn is None] == [""]
