"""Filing metadata: typed base records, de-duplication, discovery, section extraction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions import filing as fx
from tickframe.functions.conform import conform
from tickframe.functions.instants import date_part, iso_utc
from tickframe.functions.text import long_enough, normalize_whitespace
from tickframe.operators.refdata import has_value
from tickframe.schemas import FILING_SECTIONS

EXTRACTION_METHOD = "local_segmenter_v1"


def first_wins(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``latest`` columns.

    An aggregate instead of a ranked window, so copies collapse before the shuffle and a key that holds a large
    part of the table does not meet in one task. Nulls in ``latest`` lose.
    """
    rest = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*latest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def in_scope(meta: DataFrame, as_of: dt.date, form: str = "formType", filed_at: str = "filedAt") -> DataFrame:
    """The six handled forms, filed in the ten years up to and including ``as_of``, newest rule applied in UTC."""
    since = F.add_months(F.lit(as_of), -12 * fixed.FILING_YEARS)
    filed = F.to_date(F.col(filed_at).try_cast("timestamp"))
    return meta.filter(F.col(form).isin(fixed.FILING_FORMS) & filed.between(since, F.lit(as_of)))


def dedupe_filings(meta: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """First filing per (accession, ticker) in newest-first order; filings without accession are dropped."""
    return first_wins(meta.filter(has_value(F.col("accessionNo"))), ["accessionNo", "ticker"], ["filedAt", *ties])


def attach_targets(meta: DataFrame, targets: DataFrame, cik: str = "cik") -> DataFrame:
    """Each filing with the ticker and CIK of every target that asked for its company."""
    return meta.join(targets.select("ticker", cik), cik)


def download_candidates(meta: DataFrame) -> DataFrame:
    """Base form, suffix, date and target path of each complete discovered filing."""
    family = fx.form_family(F.col("formType"))
    suffix = fx.form_suffix(F.col("formType"))
    date = date_part(F.col("filedAt"))
    folder = F.concat_ws("_", "ticker", "base_form")
    return (
        meta.withColumn("base_form", family)
        .withColumn("suffix", suffix)
        .withColumn("filing_date", date)
        .filter(F.col("base_form").isNotNull() & has_value(F.col("formType")))
        .filter(has_value(F.col("filing_date")) & has_value(F.col("linkToTxt")))
        .select(
            "ticker",
            F.col("formType").alias("form_type"),
            "base_form",
            "suffix",
            "filing_date",
            F.coalesce("filedAt", F.lit("N/A")).alias("filing_timestamp"),
            F.col("linkToTxt").alias("download_url"),
            F.concat(folder, F.lit("/"), folder, "suffix", F.lit("_"), "filing_date", F.lit(".txt")).alias(
                "target_path"
            ),
        )
    )


def missing_filings(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates whose (ticker, base form, suffix, date) is not stored yet."""
    keys = ["ticker", "base_form", "suffix", "filing_date"]
    return candidates.join(stored.select(*keys).distinct(), keys, "left_anti")


def base_records(meta: DataFrame, processed_at: Column, method: str = EXTRACTION_METHOD) -> DataFrame:
    """Filing metadata as the record base; filings without a link are dropped.

    ``meta`` has the metadata columns plus ``ticker`` and the padded ``cik``.
    """
    form = F.upper(F.coalesce("formType", F.lit("")))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return meta.withColumn("source_url", fx.source_url(F.col("linkToFilingDetails"), F.col("linkToHtml"))).filter(
        F.col("source_url").isNotNull()
    ).select(
        F.col("accessionNo").alias("accession_number"),
        iso_utc(F.col("filedAt")).alias("filing_timestamp_utc"),
        F.col("periodOfReport").alias("period_end_date"),
        "cik",
        "ticker",
        F.col("companyName").alias("company_name"),
        form.alias("form_type"),
        fx.is_amendment(F.col("formType")).alias("is_amendment"),
        fx.sic_for(F.col("entities"), F.col("cik")).alias("sic_code"),
        items.alias("items_reported"),
        "source_url",
        F.lit(method).alias("extraction_method"),
        F.date_format(processed_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("processing_timestamp_utc"),
    )


def filing_sections(base: DataFrame, leading_code: bool = False) -> DataFrame:
    """One row per filing and section that applies to it, with ``section_code`` and ``section_id``."""
    sections = fx.applicable_sections(F.col("form_type"), F.col("items_reported"), leading_code)
    return (
        base.withColumn("_section", F.explode(sections))
        .withColumn("section_code", F.col("_section.code"))
        .withColumn("section_id", F.col("_section.section_id"))
        .drop("_section")
    )


def texts_from_segments(segments: DataFrame) -> DataFrame:
    """Segmented sections as (accession_number, ticker, section_code, text).

    The segmenter's key holds the item number; quarterly codes also need ``part``, as :func:`segment.with_parts` gives it.
    """
    number = F.regexp_extract("section", r"^Item_(.+)$", 1)
    code = F.when(fx.form_family(F.col("form_type")) == "8-K", F.replace(number, F.lit("."), F.lit("-"))).when(
        fx.form_family(F.col("form_type")) == "10-K", number
    )
    if "part" in segments.columns:
        quarterly = F.concat(F.lit("part"), F.col("part"), F.lit("item"), F.lower(number))
        code = F.when(F.col("part").isNotNull() & (number != ""), quarterly).otherwise(code)
    return segments.select("accession_number", "ticker", code.alias("section_code"), "text").filter(
        has_value(F.col("section_code"))
    )


def section_records(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """Section records with normalised text; sections of 50 characters or fewer are dropped.

    ``texts`` has (accession_number, ticker, section_code, text) once each, and ``wanted`` comes from filings
    that went through :func:`dedupe_filings`, so a row meets at most one other. Short texts go before the join.
    """
    kept = texts.filter(long_enough(F.col("text"), fixed.MIN_SECTION_CHARS)).withColumn(
        "text", normalize_whitespace(F.col("text"))
    )
    return conform(wanted.join(kept, ["accession_number", "ticker", "section_code"]), FILING_SECTIONS)


def whole_records(base: DataFrame, segments: DataFrame) -> DataFrame:
    """Records of filings, or of parts of quarterly ones (``P1_``, ``P2_``), that the segmenter left in one piece."""
    part = F.concat(F.lit("P"), F.col("part"), F.lit("_")) if "part" in segments.columns else F.lit(None).cast("string")
    name = F.concat(F.coalesce(part, F.lit("")), F.col("section")).alias("section_id")
    whole = segments.filter(F.col("section") == fixed.FULL_DOCUMENT).select("accession_number", "ticker", name, "text")
    return conform(base.join(whole, ["accession_number", "ticker"]), FILING_SECTIONS)


def storable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with a filing year, the rest)."""
    year = F.when(F.length("filing_timestamp_utc") >= 4, F.substring("filing_timestamp_utc", 1, 4))
    dated = records.withColumn("year", year)
    return dated.filter(F.col("year").isNotNull()), records.filter(year.isNull())
