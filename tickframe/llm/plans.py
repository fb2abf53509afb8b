"""Registered queries of the training-data operators, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (
    chat_hmm,
    decontam,
    fm_dedup,
    importance,
    kneser_ney,
    line_suffix,
    pfair,
    phrase_dedup,
    pii,
    presence_search,
    rule_ledger,
    simhash_ring,
    whitening,
)
from tickframe.llm.common import small_batches


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts are found: roles only as markers of several styles, and on a third of the turns none."""
    styles = {
        "user": ["User: ", "### Human: ", "[user] ", "**Q:** ", "> user: ", "human> "],
        "assistant": ["Assistant: ", "### AI: ", "[assistant] ", "**A:** ", "> bot: ", "model> "],
        "system": ["System: ", "### Instruction: ", "[system] ", "**System:** ", "> system: ", "sys> "],
    }
    pick = F.pmod(F.xxhash64("conv_id", "turn", "text"), F.lit(9)).cast("int")
    marker = F.lit("")
    for role, own in styles.items():
        marker = F.when(F.col("role") == role, F.coalesce(F.get(F.array(*map(F.lit, own)), pick), F.lit(""))).otherwise(marker)
    return conversations.withColumn("text", F.concat(marker, F.coalesce("text", F.lit(""))))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    model = chat_hmm.fit(shown)
    turns = chat_hmm.rendered(chat_hmm.roles(chat_hmm.lines(shown.drop("role")), model))
    return turns.withColumnRenamed("conv", "conv_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_ring.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair.mix(documents(spark, sf_dir).select("doc_id", "source"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("pii", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, pii.BASE_KINDS),
        F.sha2(pii.joined(F.col("pii"), pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.joined(F.col("pii")).alias("spans"),
        F.size("pii").cast("long").alias("n_spans"),
    )


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_suffix.without_repeated_runs(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select(
        "doc_id", "n_lines", "n_removed_lines", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = phrase_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance.resample(documents(spark, sf_dir).select("doc_id", "text"), labels)


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    stems = rule_ledger.learned_stems(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    entries = rule_ledger.ledger(docs, blocked_stems=stems)
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        rule_ledger.rejected("base").alias("base_failed"),
        (~rule_ledger.rejected()).alias("kept"),
        "fail_bits",
    )


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = kneser_ney.part() == 2
    model = kneser_ney.train(docs.where(~held_out))
    scored = kneser_ney.score(docs.withColumn("held_out", held_out), model)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fm_dedup.without_earlier_text(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT w.r, doc_id, unnest(list_transform(ws, lambda x: translate(trim(x, '{outer}'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'))) AS word FROM w),
h AS (SELECT substr(word, 1, 5) AS stem FROM p JOIN labels USING (doc_id) WHERE quality = 1 AND length(word) >= 4 AND toxic IS NOT NULL
      GROUP BY 1 HAVING count(DISTINCT r) FILTER (WHERE toxic = 1) >= 5
      AND 50 * count(DISTINCT r) FILTER (WHERE toxic <> 1) <= count(DISTINCT r) FILTER (WHERE toxic = 1)),
x AS (SELECT r, count(*) AS n_blocked FROM p WHERE word IN ({blocked})
      OR length(word) >= 4 AND substr(word, 1, 5) IN (SELECT stem FROM h) GROUP BY r),
l AS (
  SELECT r, count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE worded) - count(DISTINCT line) FILTER (WHERE worded)
    AS n_dup_lines
  FROM (SELECT r, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded
        FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d))
  GROUP BY r),
g AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS gram
      FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM w)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM t, range(8) AS o(j) GROUP BY r),
m AS (
  SELECT w.r, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_lines, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
    len(list_filter(ws, lambda x: regexp_matches(x, '[#*$%&|<>]'))) AS n_symbol_words,
    len(list_filter(ws, lambda x: contains(x, '!') AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_shouted,
    coalesce(n_blocked, 0) AS n_blocked,
    len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_stutter
  FROM w JOIN l USING (r) LEFT JOIN c USING (r) LEFT JOIN x USING (r)),
b AS (
  SELECT *, (n_words < 20)::INT AS b0, (100 * n_repeat_words > 30 * n_words)::INT AS b1,
    (n_symbol_words > 0.3 * n_words)::INT AS b2, (n_symbols > 0.3 * n_words)::INT AS b3,
    (n_words > 0 AND n_shouted > 0.4 * n_words)::INT AS b4, (n_letters > 0 AND n_upper > 0.5 * n_letters)::INT AS b5,
    (n_dup_lines > 0.5 * n_lines)::INT AS b6, (n_words > 0 AND word_chars > 25 * n_words)::INT AS b7,
    (n_blocked >= 2 AND 500 * n_blocked >= n_words)::INT AS b8, (n_words > 0 AND n_stutter > 0.3 * n_words)::INT AS b9
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 + b1 > 0 AS base_failed,
  b0 + b1 + b2 + b3 + b4 + b5 + b6 + b7 + b8 + b9 = 0 AS kept,
  (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6 + 128 * b7 + 256 * b8 + 512 * b9)::BIGINT AS fail_bits
FROM b
"""
_OP9_SQL = _OP9_SQL.replace("{blocked}", ", ".join(f"'{w}'" for w in rule_ledger.BLOCKED_WORDS)).replace("{outer}", ".,;:!?\"''()[]#*$%&|<>")


_OP5_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
a AS (SELECT doc_id, i, ls[i] AS line, len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
l AS (SELECT *, row_number() OVER w AS pos, sum(n) OVER w AS upto FROM a WHERE n > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT x.doc_id, x.pos, y.pos AS last FROM l x JOIN l y ON x.doc_id = y.doc_id AND y.pos >= x.pos AND y.upto - x.upto + x.n >= 50),
s AS (SELECT doc_id, pos, min(last) AS last FROM e GROUP BY doc_id, pos UNION SELECT doc_id, max(pos) AS pos, last FROM e GROUP BY doc_id, last),
r AS (SELECT s.doc_id, s.pos, s.last, string_agg(line, chr(10) ORDER BY l.pos) AS run
      FROM s JOIN l ON l.doc_id = s.doc_id AND l.pos BETWEEN s.pos AND s.last GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM r),
g AS (SELECT DISTINCT l.doc_id, l.pos FROM k JOIN l ON l.doc_id = k.doc_id AND l.pos BETWEEN k.pos AND k.last WHERE nth > 1),
m AS (SELECT l.*, g.pos IS NOT NULL AS gone, lag(g.pos) OVER (PARTITION BY l.doc_id ORDER BY l.pos) IS NULL AS opens
      FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.pos = l.pos),
c AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed_lines,
      count(*) FILTER (WHERE gone AND opens) AS n_runs FROM m GROUP BY doc_id),
b AS (SELECT a.doc_id, a.i, a.line, max(m.gone) FILTER (WHERE m.i = a.i) AS own,
      arg_max(m.gone, m.i) FILTER (WHERE m.i < a.i) AS before
      FROM a LEFT JOIN m ON m.doc_id = a.doc_id AND m.i <= a.i GROUP BY ALL),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT coalesce(own, before, false)) AS kept FROM b GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(n_runs, 0) AS n_runs,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


_OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS i FROM d)),
n AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
r AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 200, true) AS opens FROM w JOIN n USING (k)),
g AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b
      FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER o, 0) AS since, row_number() OVER o AS j, count(*) OVER (PARTITION BY doc_id) AS c
      FROM g WINDOW o AS (PARTITION BY doc_id ORDER BY a)),
s AS (SELECT d.doc_id, any_value(h) AS h, coalesce(sum(b - a), 0) AS gone, count(a) AS spans, coalesce(max(b), 0) AS last,
        coalesce(string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a), '') AS head
      FROM d LEFT JOIN p USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, gone::BIGINT AS n_removed, spans AS n_spans,
  sha256(unhex(concat(head, substr(h, 2 * last + 1)))) AS kept_sha256
FROM s
"""


_OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, md5_number(array_to_string(ws[i:i + 19], ' ')) AS window_key
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY window_key ORDER BY doc_id, i) AS nth FROM g) WHERE nth > 1),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM r, range(20) AS o(j)),
w AS (SELECT doc_id, pos, ws[pos] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM d)),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS kept FROM w ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
l AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM l),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM f, a GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN l USING (doc_id), a GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
_OP13_SQL = (
    _OP13_SQL.replace("{upper}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    .replace("{lower}", "abcdefghijklmnopqrstuvwxyz")
    .replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
)


def queries() -> dict:
    return {"op1_chat": op1_chat, "op2_simhash": op2_simhash, "op3_mixing": op3_mixing, "op4_pii": op4_pii, "op5_lines": op5_lines, "op6_decontamination": op6_decontamination, "op7_suffixes": op7_suffixes, "op8_importance": op8_importance, "op9_rules": op9_rules, "op10_kneser_ney": op10_kneser_ney, "op11_whitening": op11_whitening, "op12_substrings": op12_substrings, "op13_search": op13_search}


def oracle_sql() -> dict[str, str]:
    return {"op5_lines": _OP5_SQL, "op7_suffixes": _OP7_SQL, "op9_rules": _OP9_SQL, "op12_substrings": _OP12_SQL, "op13_search": _OP13_SQL}
