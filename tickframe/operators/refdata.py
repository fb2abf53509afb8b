"""Reference lists: overviews, related tickers, CIK resolution, snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import fixed
from tickframe.functions.conform import nonempty
from tickframe.functions.filing import address_line, normalize_cik, padded_cik


def clean_overview(df: DataFrame) -> DataFrame:
    """Drop ``branding``; a structured ``address`` becomes one line, any other address stays as it is."""
    df = df.drop("branding")
    if "address" in df.columns and isinstance(df.schema["address"].dataType, T.StructType):
        df = df.withColumn("address", address_line(F.col("address")))
    return df


def related_edges(df: DataFrame, ticker: str = "ticker", results: str = "results") -> DataFrame:
    """(ticker, related_ticker) for each entry of the nested array that names a ticker."""
    entries = df.select(F.col(ticker).alias("ticker"), F.explode(results).alias("_entry"))
    return entries.select("ticker", F.col("_entry.ticker").alias("related_ticker")).filter(
        F.col("related_ticker").isNotNull()
    )


def unique_tickers(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    return df.select(F.col(ticker).alias("ticker")).filter(F.col("ticker").isNotNull()).distinct()


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot. The newest value is one aggregated row, then a literal the scan can prune by."""
    newest = df.agg(F.max(snapshot).cast("string")).first()[0]
    if newest is None:
        return df.limit(0)
    return df.filter(F.col(snapshot) == F.lit(newest).cast(df.schema[snapshot].dataType))


def first_mapping(mapping: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """First non-empty ``value`` per key by ``order``; combined before the shuffle."""
    usable = mapping.filter(nonempty(F.col(value).cast("string")).isNotNull())
    return usable.groupBy(key).agg(F.min_by(F.col(value).cast("string"), order).alias(value))


def resolve_cik(
    tickers: DataFrame,
    primary: DataFrame,
    fallback: DataFrame,
    primary_order: str,
    fallback_order: str,
) -> DataFrame:
    """Add ``CIK``: the primary mapping's value, else the padded fallback of the upper-cased ticker, else NOT_FOUND.

    ``primary`` has (ticker, cik), ``fallback`` has (ticker, cik_str); both are reduced to one row per ticker.
    """
    first = first_mapping(primary, "ticker", "cik", primary_order)
    second = first_mapping(fallback, "ticker", "cik_str", fallback_order).select(
        F.col("ticker").alias("_upper"), padded_cik(F.col("cik_str")).alias("_fallback")
    )
    return (
        tickers.join(first, "ticker", "left")
        .withColumn("_upper", F.upper("ticker"))
        .join(second, "_upper", "left")
        .withColumn("CIK", F.coalesce("cik", "_fallback", F.lit(fixed.NOT_FOUND)))
        .select(*[name for name in tickers.columns if name.lower() != "cik"], "CIK")
    )


def normalized_targets(targets: DataFrame, raw: str = "CIK") -> DataFrame:
    """Targets with clean, unpadded and padded CIK and the lookup flag."""
    return targets.withColumn("_cik", normalize_cik(F.col(raw))).select(*targets.columns, "_cik.*")


def usable_targets(targets: DataFrame, raw: str = "CIK") -> tuple[DataFrame, DataFrame]:
    """(targets with a numeric CIK, the rest)."""
    normal = normalized_targets(targets, raw)
    return normal.filter(~F.col("needs_lookup")), normal.filter("needs_lookup")


def per_ticker(tickers: DataFrame, landed: DataFrame, post: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Landed results of the listed tickers, post-processed; tickers without a result are left out."""
    found = landed.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    return found.transform(post) if post else found


def has_value(column: Column) -> Column:
    return nonempty(column).isNotNull()
