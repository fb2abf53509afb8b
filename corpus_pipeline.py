"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import decontam, line_suffix, pfair, rule_ledger, simhash_ring
from tickframe.llm.common import new_folder, packed_rest, small_batches, unpacked_rest

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shingle length of the near-dedup stage; its links differ in ``simhash_ring.DISTANCE`` bits at most.
NEAR_WORDS = 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger keeps."""
    small_batches(spark)
    stems = rule_ledger.learned_stems(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    entries = rule_ledger.ledger(packed_rest(docs, "text"), blocked_stems=stems)
    return unpacked_rest(rule_ledger.apply_policy(entries), docs.columns, "text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut; documents of which nothing but blanks is left by that go."""
    small_batches(spark)
    own = ("doc_id", "text", "n_chars")
    cut = line_suffix.without_repeated_runs(packed_rest(docs, *own))
    emptied = (F.col("n_removed_lines") > 0) & (F.col("n_removed_lines") == F.col("n_lines"))
    length = F.when(F.col("n_removed_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return unpacked_rest(cut.where(~emptied).withColumn("n_chars", length), docs.columns, *own)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their fingerprints its first one."""
    small_batches(spark)
    return simhash_ring.first_of_groups(docs, width=NEAR_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    small_batches(spark)
    found = decontam.with_leaks(packed_rest(docs, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return unpacked_rest(found.where(F.size("leaks") == 0), docs.columns, "text")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix."""
    return pfair.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Fingerprint groups and alignments can't be said in SQL; tests/llm hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
