"""Catalogue of datasets: where a dataset lies, what it is filtered by and how it is ordered."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.instants import day_start_ns
from tickframe.operators.targets import merged_ranges
from tickframe.sources.landed import read_answers


@dataclass(frozen=True)
class Dataset:
    """``date`` is the range column (``unit`` tells how it is stored), ``fixed`` are constant equality filters."""

    folder: str
    ticker: str | None = "ticker"
    date: str | None = None
    unit: str = "date"
    fixed: tuple[tuple[str, str], ...] = ()
    nested: tuple[str, ...] = ("results",)
    shape: str = "array"
    order: str | None = None


DATASETS = {
    "stock_tickers": Dataset("reference/tickers", None, fixed=(("market", "stocks"), ("active", "true"))),
    "currency_tickers": Dataset("reference/tickers", None, fixed=(("market", "fx"),)),
    "index_tickers": Dataset("reference/tickers", None, fixed=(("market", "indices"),)),
    "option_contracts": Dataset("reference/options", None),
    "stock_overviews": Dataset("stocks/overviews", shape="object"),
    "currency_overviews": Dataset("currency/overviews", shape="object"),
    "index_overviews": Dataset("indices/overviews", shape="object"),
    "option_overviews": Dataset("options/overviews", shape="object"),
    "related_companies": Dataset("stocks/relatives"),
    "bars": Dataset("stocks/bars", date="t", unit="ms", order="t"),
    "trades": Dataset("stocks/trades", date="sip_timestamp", unit="ns", order="sip_timestamp"),
    "sma": Dataset("stocks/technicals/sma", date="timestamp", unit="ms", nested=("results", "values")),
    "ema": Dataset("stocks/technicals/ema", date="timestamp", unit="ms", nested=("results", "values")),
    "rsi": Dataset("stocks/technicals/rsi", date="timestamp", unit="ms", nested=("results", "values")),
    "macd": Dataset("stocks/technicals/macd", date="timestamp", unit="ms", nested=("results", "values")),
    "ipo": Dataset("stocks/corporate_actions/ipo", date="date"),
    "splits": Dataset("stocks/corporate_actions/splits", date="execution_date"),
    "dividends": Dataset("stocks/corporate_actions/dividends", date="ex_dividend_date"),
    "ticker_events": Dataset("stocks/corporate_actions/ticker_events", date="date"),
    "financials": Dataset("stocks/fundamentals/financials", date="filing_date"),
    "short_interest": Dataset("stocks/fundamentals/short_interest", date="report_date"),
    "short_volume": Dataset("stocks/fundamentals/short_volume", date="date"),
    "treasury_yields": Dataset("macro/treasury_yields", None, date="date", order="date"),
    "inflation": Dataset("macro/inflation", None, date="date", order="date"),
    "inflation_expectations": Dataset("macro/inflation_expectations", None, date="date", order="date"),
    "cik_primary": Dataset("reference/cik_primary", shape="root_array"),
    "cik_fallback": Dataset("reference/cik_fallback", shape="root_array"),
    "filing_sections": Dataset("filings/sections", "ticker", date="filing_timestamp_utc", unit="iso"),
    "filings": Dataset("filings/metadata", "cik", date="filedAt", unit="iso", nested=("filings",)),
}


def scan(
    df: DataFrame,
    dataset: Dataset,
    ticker: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Rows of ``dataset`` for a ticker and days [start, end]; instants are taken up to the end of the last day.

    All predicates are literals on raw columns.
    """
    for column, value in dataset.fixed:
        kind = df.schema[column].dataType
        df = df.filter(F.col(column) == (value == "true" if isinstance(kind, T.BooleanType) else F.lit(value).cast(kind)))
    if ticker is not None and dataset.ticker:
        df = df.filter(F.col(dataset.ticker) == ticker)
    if dataset.date and dataset.unit == "iso":
        return _utc_days(df, dataset.date, start, end)
    if dataset.date:
        column = F.col(dataset.date)
        after_end = end + dt.timedelta(days=1) if end else None
        if start is not None:
            df = df.filter(column >= _bound(start, dataset.unit))
        if after_end is not None:
            df = df.filter(column < _bound(after_end, dataset.unit))
    return df


def _utc_days(df: DataFrame, column: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Rows whose instant, text with its own offset, lies in UTC days [start, end].

    No offset moves a day by more than one, so a text range a day wider is pushed to the scan.
    """
    day = F.to_date(F.col(column).try_cast("timestamp"))
    if start is not None:
        df = df.filter((F.col(column) >= (start - dt.timedelta(days=1)).isoformat()) & (day >= F.lit(start)))
    if end is not None:
        df = df.filter((F.col(column) < (end + dt.timedelta(days=2)).isoformat()) & (day <= F.lit(end)))
    return df


def _bound(day: dt.date, unit: str):
    if unit == "ns":
        return F.lit(day_start_ns(day))
    if unit == "ms":
        return F.lit(day_start_ns(day) // 1_000_000)
    return F.lit(day.isoformat())


def range_scan(
    spark: SparkSession,
    root: str,
    name: str,
    ticker: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Stored dataset ``name`` under ``root``, restricted to a ticker and days; sorted only when asked for."""
    dataset = DATASETS[name]
    found = scan(spark.read.parquet(f"{root}/{dataset.folder}"), dataset, ticker, start, end)
    return found.orderBy(dataset.order) if ordered and dataset.order else found


def _bound_of(day: Column, unit: str) -> Column:
    """:func:`_bound` of a column of days."""
    if unit == "iso":
        raise ValueError("instants as text are read by day, not by range")
    scale = {"ns": 86_400 * 10**9, "ms": 86_400_000}.get(unit)
    return F.unix_date(day).cast("bigint") * scale if scale else F.date_format(day, "yyyy-MM-dd")


#: Ranges (by month) that are sent to every executor, some 60 bytes each.
MOST_RANGES = 500_000


def target_scan(spark: SparkSession, root: str, name: str, targets: DataFrame) -> DataFrame:
    """Rows of a stored dataset inside the ``start_date`` to ``end_date`` of a target with their ticker, each row once.

    The targets, merged per ticker, are one side of an equality on the dataset's ticker and, where it is stored by ``month``, on the
    months of the ranges. Up to ``MOST_RANGES`` of them, which are counted first, are broadcast; where those columns are
    partition columns, only folders of their tickers and of their months are then read. More of them are joined as Spark sees fit.
    """
    dataset = DATASETS[name]
    if not dataset.ticker or not dataset.date:
        raise ValueError(f"{name} has no ticker and date to scan by")
    found = spark.read.parquet(f"{root}/{dataset.folder}")
    for column, value in dataset.fixed:
        found = found.filter(F.col(column) == F.lit(value).cast(found.schema[column].dataType))
    # The comparison drops empty ranges, and tells Spark that the targets select.
    ranges = merged_ranges(targets.filter(F.col("start_date") <= F.col("end_date"))).select(
        F.col("ticker").alias("_ticker"), F.col("start_date").alias("_start"), F.col("end_date").alias("_end")
    )
    ranges = ranges.filter(F.col("_start") <= F.col("_end"))
    same = F.col(dataset.ticker) == F.col("_ticker")
    if "month" in found.columns:
        months = F.sequence(F.trunc("_start", "MM"), F.trunc("_end", "MM"), F.expr("INTERVAL 1 MONTH"))
        ranges = ranges.withColumn("_month", F.explode(F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))))
        same = same & (F.col("month") == F.col("_month"))
    if ranges.limit(MOST_RANGES + 1).count() <= MOST_RANGES:
        ranges = F.broadcast(ranges)
    date, after = F.col(dataset.date), F.date_add(F.col("_end"), 1)
    inside = (date >= _bound_of(F.col("_start"), dataset.unit)) & (date < _bound_of(after, dataset.unit))
    return found.join(ranges, same & inside).select(*(found[c] for c in found.columns))


def landed_pages(spark: SparkSession, path: str, name: str, row: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, unreadable answers) of landed answers of dataset ``name``, taken from where its answers hold them."""
    dataset = DATASETS[name]
    return read_answers(spark, path, row, dataset.shape, dataset.nested)
