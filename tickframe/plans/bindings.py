"""Test tables seen as the engine's logical inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.instants import lookback_cutoff_ns
from tickframe.session import use_utc

AS_OF = dt.date(2024, 1, 31)

# SQL text that reads the same in Spark and in the reference engine.
FORM = (
    "CASE doc_id % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '8-K' "
    "WHEN 3 THEN '10-K/A' WHEN 4 THEN 'NT 10-Q' ELSE 's-1' END"
)
ACCESSION = "lpad(CAST(doc_id AS STRING), 12, '0')"
CIK = "lpad(CAST(doc_id % 97 AS STRING), 10, '0')"
DETAILS_LINK = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('https://a.example/', doc_id) END"
HTML_LINK = "CASE doc_id % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('https://b.example/', doc_id) END"
TXT_LINK = "CASE doc_id % 7 WHEN 0 THEN '' ELSE concat('https://c.example/', doc_id, '.txt') END"
FIDELITY = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN '15 minute' WHEN 'AUTOMOBILE' THEN ' Day ' WHEN 'HOUSEHOLD' THEN 'tick' "
    "WHEN 'MACHINERY' THEN '5-day' ELSE '' END"
)
MIXED_FIDELITY = (
    "CASE c_custkey % 9 WHEN 0 THEN 'tick' WHEN 1 THEN ' Day ' WHEN 2 THEN concat(c_custkey, ' Minute') "
    "WHEN 3 THEN concat(c_custkey, '-minute') WHEN 4 THEN concat(c_custkey, '  foo') WHEN 5 THEN 'week' "
    "WHEN 6 THEN '' WHEN 7 THEN concat('x', c_custkey, ' day') END"
)
RAW_CIK = (
    "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'NOT_FOUND' WHEN 2 THEN concat(c_custkey, '.0') "
    "WHEN 3 THEN lpad(CAST(c_custkey AS STRING), 10, '0') WHEN 4 THEN '0' "
    "WHEN 5 THEN concat('12345678901', c_custkey) ELSE 'ERROR' END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Text columns of a table for costly per-row work, the key first.

    Each test table is one file of one row group, which a scan can't split; dealing the rows by key is a matter of these
    bindings, no operator does so.
    """
    return table(spark, sf_dir, name).select(*columns).repartition(columns[0])


def trades(
    spark: SparkSession, sf_dir: str, ticker: str = "event_type", as_of: dt.date | None = None, days: int = 0
) -> DataFrame:
    """``events`` as trades. The lookback is applied to the stored column, so the scan sees it."""
    events = table(spark, sf_dir, "events")
    if as_of is not None:
        cutoff = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=lookback_cutoff_ns(as_of, days) // 10**9)
        events = events.filter(F.col("ts") >= F.lit(cutoff.isoformat(" ")).cast("timestamp_ntz"))
    return events.select(
        F.col(ticker).cast("string").alias("ticker"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("sip_timestamp"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_id").alias("sequence_number"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as download targets, some of them unusable."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("ticker"),
        F.expr(FIDELITY).alias("ticker_fidelity"),
        F.when(F.col("c_custkey") % 10 == 9, "n/a")
        .otherwise((F.col("c_custkey") % 25).cast("string"))
        .alias("ticker_duration_months"),
    )


def filed_at(doc_id: str = "doc_id") -> str:
    """Spark SQL text of the filing instant: one hour per document, five hours behind UTC."""
    return (
        f"concat(date_format(timestampadd(HOUR, CAST({doc_id} % 50000 AS INT), timestamp_ntz'2023-06-01 00:00:00'), "
        "\"yyyy-MM-dd'T'HH:mm:ss\"), '-05:00')"
    )


def filings(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``documents`` as filing metadata; ``keep`` names further columns of the table."""
    return table(spark, sf_dir, "documents").select(
        *keep,
        F.expr(FORM).alias("formType"),
        F.expr(DETAILS_LINK).alias("linkToFilingDetails"),
        F.expr(HTML_LINK).alias("linkToHtml"),
        F.expr(TXT_LINK).alias("linkToTxt"),
        F.expr(ACCESSION).alias("accessionNo"),
        F.expr(filed_at()).alias("filedAt"),
        F.expr(
            "CASE WHEN doc_id % 11 > 0 THEN CAST(date_sub(date'2023-12-31', CAST(doc_id % 8 * 91 AS INT)) AS STRING) END"
        ).alias("periodOfReport"),
        F.concat(F.lit("Company "), "source").alias("companyName"),
        F.expr(
            "CASE doc_id % 4 WHEN 0 THEN array('Item 1.01', 'Item 9.01') WHEN 1 THEN array(' Item 8.01 ') "
            "WHEN 2 THEN array('Item 2.02', 'Item 7.01', 'Item 2.02', 'Item 5.02 Departure') "
            "ELSE CAST(array() AS array<string>) END"
        ).alias("items"),
        F.expr(
            "CASE WHEN doc_id % 9 = 0 THEN CAST(array() AS array<struct<cik:string,sic:string>>) ELSE array("
            "named_struct('cik', CAST(doc_id % 96 AS STRING), 'sic', concat('A', doc_id % 13)), "
            "named_struct('cik', CAST(doc_id % 97 AS STRING), 'sic', concat('B', doc_id % 13))) END"
        ).alias("entities"),
        F.col("source").alias("ticker"),
        F.expr(CIK).alias("cik"),
    )


def section_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as stored section records: a conversation is a filing, a turn is a section."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "lpad(CAST(conv_id AS STRING), 12, '0') AS accession_number",
        "concat(date_format(timestampadd(HOUR, CAST(conv_id % 50000 AS INT), timestamp_ntz'2023-06-01 00:00:00'), "
        "\"yyyy-MM-dd'T'HH:mm:ss\"), 'Z') AS filing_timestamp_utc",
        "CASE WHEN conv_id % 11 > 0 THEN CAST(date_sub(date'2023-12-31', CAST(conv_id % 8 * 91 AS INT)) AS STRING) END "
        "AS period_end_date",
        "lpad(CAST(conv_id % 97 AS STRING), 10, '0') AS cik",
        "concat('T', conv_id % 7) AS ticker",
        "concat('Company ', conv_id % 7) AS company_name",
        "CASE conv_id % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' ELSE '8-K' END AS form_type",
        "CASE WHEN conv_id % 3 = 2 THEN array('Item 1.01', 'Item 8.01') ELSE CAST(array() AS array<string>) END "
        "AS items_reported",
        "CASE turn WHEN 0 THEN 'Item_1_Business' WHEN 1 THEN 'P2_Item_1A_Risk_Factors' WHEN 2 THEN 'Other_Part' "
        "WHEN 3 THEN 'P1_Item_2_MDandA' ELSE 'Item_8_01_Other_Events' END AS section_id",
        "text",
        "conv_id * 1000 + turn AS ordinal",
    )
