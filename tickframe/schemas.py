"""Explicit schemas of every landed dataset."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _TEXT, _FLAG = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _texts(*names: str) -> T.StructType:
    return _struct(**{name: _TEXT for name in names})


TRADES = _struct(
    sip_timestamp=_LONG,
    participant_timestamp=_LONG,
    trf_timestamp=_LONG,
    id=_TEXT,
    sequence_number=_LONG,
    exchange=_LONG,
    price=_DOUBLE,
    size=_LONG,
    conditions=T.ArrayType(_LONG),
    tape=_LONG,
    trf_id=_LONG,
)

BARS = _struct(
    ticker=_TEXT, t=_LONG, o=_DOUBLE, h=_DOUBLE, l=_DOUBLE, c=_DOUBLE, v=_DOUBLE, vw=_DOUBLE, n=_LONG
)

INDICATOR_VALUES = _struct(timestamp=_LONG, value=_DOUBLE, signal=_DOUBLE, histogram=_DOUBLE)

TARGETS = _texts("ticker", "ticker_fidelity", "ticker_duration_months")

CIK_TARGETS = _texts("ticker", "CIK")

ADDRESS = _texts("address1", "city", "state", "postal_code")

RELATED = _texts("ticker")

FILING_META = T.StructType(
    _texts(
        "formType",
        "linkToFilingDetails",
        "linkToHtml",
        "linkToTxt",
        "accessionNo",
        "filedAt",
        "periodOfReport",
        "companyName",
    ).fields
    + _struct(items=T.ArrayType(_TEXT), entities=T.ArrayType(_texts("cik", "sic"))).fields
)

FILING_SECTIONS = _struct(
    accession_number=_TEXT,
    filing_timestamp_utc=_TEXT,
    period_end_date=_TEXT,
    cik=_TEXT,
    ticker=_TEXT,
    company_name=_TEXT,
    form_type=_TEXT,
    is_amendment=_FLAG,
    sic_code=_TEXT,
    items_reported=T.ArrayType(_TEXT),
    source_url=_TEXT,
    extraction_method=_TEXT,
    processing_timestamp_utc=_TEXT,
    section_id=_TEXT,
    text=_TEXT,
)

SEGMENTS = _texts("ticker", "form_type", "filing_date", "filing_timestamp", "section", "text")

DOWNLOAD_LIST = _texts("ticker", "form_type", "filing_date", "filing_timestamp", "download_url", "target_path")

ERROR_LOG = _texts(
    "log_timestamp_utc",
    "script_name",
    "ticker",
    "fidelity",
    "failed_chunk_start",
    "failed_chunk_end",
    "reason",
)


def page_envelope(row: T.StructType, *path: str) -> T.StructType:
    """Schema of one API page: an array of ``row`` under ``path`` (default ``results``) and ``next_url``."""
    names = path or ("results",)
    node: T.DataType = T.ArrayType(row)
    for name in reversed(names[1:]):
        node = T.StructType([T.StructField(name, node)])
    return T.StructType([T.StructField(names[0], node), T.StructField("next_url", T.StringType())])
